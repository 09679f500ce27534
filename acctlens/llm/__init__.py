"""Training-data operators: near-duplicate detection, tokenisation,
classification, search, mixing and URL rules over corpus tables.

Nothing outside this package imports it; its named queries are in
``acctlens.llm.queries``."""

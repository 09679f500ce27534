"""Training-corpus pipeline: documents -> filtered, deduplicated, mixed, tokenised.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acctlens.llm.bpe import tokenised
from acctlens.llm.common import stored, table
from acctlens.llm.mixing import mixed_documents
from acctlens.llm.quality import keep_good
from acctlens.llm.queries import tokenizer_files
from acctlens.llm.simhash import drop_near_copies
from acctlens.llm.suffixes import drop_repeats

REJECT_BELOW = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go: those it scores
    under REJECT_BELOW, on the far side of 0.5 so that clean documents stay."""
    return keep_good(docs, table(spark, sf_dir, "labels"), reject_below=REJECT_BELOW)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_copies(docs, words_in_shingle=3, bits=3)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by 50-byte strings of an earlier document are cut."""
    return drop_repeats(docs, width=50)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; a document appears once for
    each copy or piece that the mix takes of it."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding them."""
    return tokenised(docs, *tokenizer_files())


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_copies), ("suffix-array dedup", repeats),
          ("mixing sources to target weights", mix), ("byte-level BPE encoding and decoding", tokens)]

#: Classifier, SimHash and tokenizer can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline_" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)

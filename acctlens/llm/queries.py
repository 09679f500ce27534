"""The registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlens.llm.ann import ann_search
from acctlens.llm.bpe import bpe_digests
from acctlens.llm.common import table
from acctlens.llm.merkle import merkle_manifest
from acctlens.llm.mixing import mix_sizes
from acctlens.llm.packing import placed, token_pieces
from acctlens.llm.passages import passage_classes
from acctlens.llm.quality import quality_scores
from acctlens.llm.simhash import simhash_groups
from acctlens.llm.suffixes import suffix_dedup
from acctlens.llm.topk import exact_top_k
from acctlens.llm.toxicity import toxicity_scores
from acctlens.llm.url_rules import apply_rules
from acctlens.llm.whitening import whiten

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_files(folder: str | None = None) -> tuple[str, str]:
    """(path of the rank file, pattern that splits text); ``folder`` is where
    the vocabulary files are, if not with their module."""
    import public_tokenizers  # only the tokenizer queries need it

    return f"{folder}/{RANKS}" if folder else public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), words_in_shingle=3, bits=3)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer_files()
    return bpe_digests(table(spark, sf_dir, "documents"), ranks, pattern)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), width=50)


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return apply_rules(table(spark, sf_dir, "pages"), rules, default="allow")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_classes(table(spark, sf_dir, "documents"), similarity=0.8)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations that a long can't hold are null."""
    white = whiten(table(spark, sf_dir, "embeddings"), components=32)
    long = white.select(F.col("id").alias("vec_id"), "n", F.col("deviation").try_cast("long").alias("deviation"), "explained",
                        "identity_error", F.posexplode("whitened").alias("place", "whitened"))
    return long.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened",
                       F.get("explained", F.col("place")).alias("explained"), "identity_error")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"), every=5).drop("proof")


WORDS = "word_bpe_49k.json"


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # only the tokenizer queries need it

    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), capacity=4096)
    return placed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity=4096)


QUERIES = {"op1_simhash": op1_simhash, "op2_byte_bpe": op2_byte_bpe, "op3_quality": op3_quality,
           "op4_exact_top_k": op4_exact_top_k, "op5_suffix_dedup": op5_suffix_dedup, "op6_url_rules": op6_url_rules, "op7_ann": op7_ann,
           "op8_mix_sources": op8_mix_sources, "op9_toxicity": op9_toxicity,
           "op10_substring_dedup": op10_substring_dedup, "op11_whitening": op11_whitening, "op12_merkle": op12_merkle,
           "op13_packing": op13_packing}

OP4_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::double)::bigint FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([z[1] * z[2] FOR z IN list_zip(q.e, c.e)])::bigint AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

# bytes as two hex digits each; spans are runs of covered bytes, touching ones are one
OP5_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS s
      FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE doc_id IS NOT NULL)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
hit AS (SELECT w.r, w.i FROM w JOIN m ON w.s = m.s WHERE m.least < w.doc_id),
isl AS (SELECT r, i, sum(CASE WHEN prev IS NULL OR i > prev + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k
        FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS prev FROM hit)),
span AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM isl GROUP BY r, k),
cut AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS after FROM span),
parts AS (SELECT cut.r, string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS before_last,
                 max(b) AS last, sum(b - a) AS removed, count(*) AS n
          FROM cut JOIN d ON cut.r = d.r GROUP BY cut.r)
SELECT d.doc_id, (length(h) // 2)::bigint AS n_bytes, coalesce(removed, 0)::bigint AS n_removed,
       coalesce(n, 0)::bigint AS n_spans,
       sha256(unhex(CASE WHEN parts.r IS NULL THEN h ELSE before_last || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN parts ON d.r = parts.r
"""

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
OP6_SQL = f"""
WITH rules(h, p, v) AS (VALUES {_RULES_SQL}),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
u AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split),
m AS (SELECT u.*, h || p AS rule, v, row_number() OVER (
        PARTITION BY page_id ORDER BY (h IS NULL), length(h || p) DESC, length(h) DESC) AS k
      FROM u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""

# one statement a level: runs of 16 hash to their parent while a tree has more than one node
MERKLE_LEVELS, MERKLE_TOP = 6, 4


def _merkle_levels(name: str, levels: int) -> str:
    """CTEs ``name``0 (tree, pos, total, digest) are given; adds the levels above and, for each, its runs."""
    out = []
    for k in range(levels):
        out.append(f"{name}run{k} AS (SELECT tree, pos // 16 AS run, any_value(total) AS total, list(digest ORDER BY pos) AS ds "
                   f"FROM {name}{k} GROUP BY tree, pos // 16)")
        out.append(f"{name}{k + 1} AS (SELECT tree, run AS pos, (total + 15) // 16 AS total, "
                   f"CASE WHEN total = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS digest FROM {name}run{k})")
    return ",\n".join(out)


def _merkle_path(rows: str, name: str, levels: int, tag: str) -> str:
    """CTEs that lead ``rows`` (tree, pos, proof, folded, ...) up through the levels of ``name``."""
    out, last = [], rows
    for k in range(levels):
        at = f"(a.pos // {16 ** k})"
        before, after = f"array_to_string(ds[1:{at} % 16], '')", f"array_to_string(ds[{at} % 16 + 2:], '')"
        out.append(f"{tag}{k} AS (SELECT a.* REPLACE (CASE WHEN r.total = 1 THEN proof ELSE proof || {before} || {after} END AS proof, "
                   f"CASE WHEN r.total = 1 THEN folded ELSE sha256({before} || folded || {after}) END AS folded) "
                   f"FROM {last} a JOIN {name}run{k} r ON a.tree = r.tree AND {at} // 16 = r.run)")
        last = f"{tag}{k}"
    return ",\n".join(out)


def _crc32(text: str) -> str:
    byte = ("list_reduce([xor(c, b)] || [0::ubigint FOR _ IN range(8)], "
            "lambda r, z: xor(r >> 1, 3988292384::ubigint * (r & 1)))")
    return (f"(4294967295 - list_reduce([4294967295::ubigint] || [ascii(x)::ubigint FOR x IN string_split({text}, '')], "
            f"lambda c, b: {byte}))")


def _merkle_leaf(text: str) -> str:
    fields = [f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


OP12_SQL = f"""
WITH d AS (SELECT doc_id, coalesce('+' || source, '') AS tree, {_merkle_leaf("text")} AS leaf,
                  {_merkle_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered FROM documents),
doc AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS total,
               CASE WHEN doc_id IS NOT NULL AND {_crc32("doc_id::varchar")} % 5 = 0 THEN lowered ELSE leaf END AS first FROM d),
s0 AS (SELECT tree, pos, total, leaf AS digest FROM doc),
{_merkle_levels("s", MERKLE_LEVELS)},
t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS total, digest, tree AS source FROM s{MERKLE_LEVELS}),
{_merkle_levels("t", MERKLE_TOP)},
p AS (SELECT doc_id, tree, pos, leaf, '' AS proof, first AS folded FROM doc),
{_merkle_path("p", "s", MERKLE_LEVELS, "up")},
q AS (SELECT u.doc_id, u.leaf, t0.digest AS subroot, u.proof, u.folded, t0.tree, t0.pos FROM up{MERKLE_LEVELS - 1} u JOIN t0 ON u.tree = t0.source),
{_merkle_path("q", "t", MERKLE_TOP, "on")}
SELECT doc_id, leaf, subroot, (SELECT digest FROM t{MERKLE_TOP}) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = (SELECT digest FROM t{MERKLE_TOP}) AS verified
FROM on{MERKLE_TOP - 1}
"""

ORACLE_SQL = {"op12_merkle": OP12_SQL, "op4_exact_top_k": OP4_SQL, "op5_suffix_dedup": OP5_SQL, "op6_url_rules": OP6_SQL}

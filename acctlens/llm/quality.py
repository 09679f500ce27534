"""Quality classifier by co-training two views of a document.

The content view sees the text only; the metadata view sees source, language
and recorded length only.  Both are fitted on labelled rows; in each round either
view labels the unlabelled rows it is sure of (``sure`` or beyond, in the
proportion of the classes) and hands them to the other.  At the end the log-odds
of both views are calibrated together on labelled rows that neither was fitted
on, and every document is scored.

Fitting uses at most ``labelled`` labelled and ``pool`` unlabelled rows (documented
bounds), drawn by a hash of doc_id; their features, not their texts, reach the driver.
Rows whose crc32(doc_id) mod 5 is 0 are held out.  Features, and the scores of all
documents, are computed where the documents are.
"""

from __future__ import annotations

import math
import zlib
from itertools import groupby, islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.linear import Logistic

LABELLED, POOL = 8192, 8192
SOURCE_BUCKETS, LANG_BUCKETS = 32, 8
CONTENT, META = 15, 3 + SOURCE_BUCKETS + LANG_BUCKETS  # features of the views


def content_features(text: str) -> list[float]:
    """Shares of a text that tell prose from junk; an empty text has zeros."""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * CONTENT
    tails = [w[-1:] for w in words]
    letters = sum(map(str.isalpha, words))
    lines = text.split("\n")
    longest = max(sum(1 for _ in g) for _, g in groupby(words))
    return [
        math.log1p(n), chars / n, len(set(words)) / n,
        sum(map(eq, words, islice(words, 1, None))) / n, math.log1p(longest),
        sum(map(str.isupper, words)) / n, letters / n,
        sum(map("|".__eq__, words)) / n, text.count("!") / n, text.count(".") / n,
        sum(text.count(c) for c in "#$%&*@^~<>{}[]\\=_+") / n,
        sum(map(text.count, "0123456789")) / chars,
        len(set(lines)) / len(lines), n / len(lines) / 100.0,
        sum(map(str.isalnum, tails)) / n,
    ]


def metadata_features(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    s, g = [0.0] * SOURCE_BUCKETS, [0.0] * LANG_BUCKETS
    s[zlib.crc32((source or "").encode()) % SOURCE_BUCKETS] = 1.0
    g[zlib.crc32((lang or "").encode()) % LANG_BUCKETS] = 1.0
    size = math.log1p(max(0, n_chars or 0))
    return [size, size * size, float(n_chars is None), *s, *g]


def views(rb: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both feature matrices of a batch with text, source, lang, n_chars."""
    col = {n: rb.column(rb.schema.get_field_index(n)).to_pylist() for n in ("text", "source", "lang", "n_chars")}
    content = np.array([content_features(t or "") for t in col["text"]])
    meta = np.array([metadata_features(*x) for x in zip(col["source"], col["lang"], col["n_chars"])])
    return content.reshape(rb.num_rows, CONTENT), meta.reshape(rb.num_rows, META)


class CoTrained:
    """Two views that teach each other, and their calibrated sum."""

    def __init__(self, rounds: int = 4, sure: float = 0.95, per_round: int = 512):
        self.rounds, self.sure, self.per_round = rounds, sure, per_round

    def fit(self, a, b, y, pool_a, pool_b, holdback) -> "CoTrained":
        """``holdback`` marks the labelled rows kept for calibration."""
        fit = ~holdback
        xs, ys = [[a[fit]], [b[fit]]], [[y[fit]], [y[fit]]]
        pools = [pool_a, pool_b]
        free = [np.ones(len(pool_a), bool), np.ones(len(pool_a), bool)]
        share = float(y[fit].mean()) if fit.any() else 0.5
        for _ in range(self.rounds):
            models = self._models(xs, ys)
            for me, other in ((0, 1), (1, 0)):
                p = models[me].predict(pools[me]) if len(pools[me]) else np.zeros(0)
                for label, score, part in ((1.0, p, share), (0.0, 1 - p, 1 - share)):
                    rows = np.flatnonzero((score >= self.sure) & free[other])
                    rows = rows[np.argsort(-score[rows], kind="stable")][: int(self.per_round * part)]
                    free[other][rows] = False
                    xs[other].append(pools[other][rows])
                    ys[other].append(np.full(len(rows), label))
        self.a, self.b = self._models(xs, ys)
        rows = holdback if holdback.any() else np.ones(len(y), bool)
        self.both = Logistic(ridge=0.1).fit(self._logits(a[rows], b[rows]), y[rows])
        return self

    @staticmethod
    def _models(xs, ys):
        return [Logistic().fit(np.concatenate(x), np.concatenate(y)) for x, y in zip(xs, ys)]

    def _logits(self, a, b):
        return np.stack([self.a.logit(a), self.b.logit(b)], axis=1)

    def predict(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.both.predict(self._logits(a, b)) if len(a) else np.zeros(0)


def _columns(docs: DataFrame) -> DataFrame:
    """doc_id and what the views read; a missing metadata column is null."""
    have = set(docs.columns)
    pick = lambda c, t: (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
    return docs.select(pick("doc_id", "long"), pick("text", "string"), pick("source", "string"), pick("lang", "string"),
                       pick("n_chars", "long"))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL, **options) -> CoTrained:
    """Fit on bounded samples; labels that are null, or contradict each other
    on one doc_id, are left out."""
    known = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("y"), F.max("quality").alias("y2")).filter("y = y2"))
    by_hash = F.xxhash64(F.lit(17), "doc_id")
    train = known.filter(~held_out()).orderBy(by_hash, "doc_id").limit(labelled).select("doc_id", "y")
    total = docs.count()
    rows = _columns(docs)
    with_y = rows.join(F.broadcast(train), "doc_id")  # at most ``labelled`` rows
    # a fraction by hash of about the pool's size, then a bound
    part = min(1.0, 1.2 * pool / max(1, total))
    others = (rows.filter(F.pmod(by_hash, F.lit(1 << 20)) < int(part * (1 << 20)) + 1)
              .join(known.select("doc_id"), "doc_id", "left_anti").filter(~held_out()).limit(pool)
              .withColumn("y", F.lit(None).cast("int")))
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("a", pa.list_(pa.float64())), ("b", pa.list_(pa.float64()))])

    def features(batches):
        for rb in batches:
            a, b = views(rb)
            yield pa.RecordBatch.from_arrays([rb.column(rb.schema.get_field_index("doc_id")),
                                              rb.column(rb.schema.get_field_index("y")).cast(pa.int32()),
                                              pa.array(a.tolist(), schema[2].type), pa.array(b.tolist(), schema[3].type)], schema=schema)

    got = with_y.unionByName(others).mapInArrow(features, "doc_id long, y int, a array<double>, b array<double>").toArrow()
    a = np.array(got.column("a").to_pylist(), float).reshape(got.num_rows, CONTENT)
    b = np.array(got.column("b").to_pylist(), float).reshape(got.num_rows, META)
    y = np.array([math.nan if v is None else float(v) for v in got.column("y").to_pylist()])
    ids = got.column("doc_id").to_pylist()
    order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, tuple(a[i]))), int)
    a, b, y = a[order], b[order], y[order]
    has = ~np.isnan(y)
    back = np.array([ids[i] is not None and zlib.crc32(f"c{ids[i]}".encode()) % 4 == 0 for i in order], bool)
    return CoTrained(**options).fit(a[has], b[has], y[has], a[~has], b[~has], back[has])


def score_quality(docs: DataFrame, model: CoTrained) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null text counts as empty, null metadata as a value of its own; repeated
    rows repeat; a null doc_id stays.  Empty table: empty result.  Without labels
    every score is 0.5 and every document is kept.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for rb in batches:
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(model.predict(*views(rb)), pa.float64())], schema=schema)

    scored = _columns(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score_quality(docs, fit_quality(docs, labels, **options))


def keep_good(docs: DataFrame, labels: DataFrame, reject_below: float = 0.5, **options) -> DataFrame:
    """``docs`` less the rows scored under ``reject_below``; all columns stay."""
    model = fit_quality(docs, labels, **options)
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    kinds = {"text": pa.string(), "source": pa.string(), "lang": pa.string(), "n_chars": pa.int64()}

    def run(batches):
        for rb in batches:
            read = {n: rb.column(names.index(n)).cast(t) if n in names else pa.nulls(rb.num_rows, t) for n, t in kinds.items()}
            good = model.predict(*views(pa.RecordBatch.from_pydict(read))) >= reject_below
            yield rb.filter(pa.array(good))

    return rows.mapInArrow(run, rows.schema).toDF(*names)

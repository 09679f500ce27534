"""Mixing sources to target weights by Sainte-Lague apportionment.

Only DataFrame expressions: sizes, targets, seats, shard quotas and the
selected words of every document are columns.

1. Size of a document: its words.  Sources in code-point order (null last)
   carry repeating weights and share ``share`` times all words; a source's
   target stops at ``max_repeat`` times its size and the excess is reshared by
   weight.  The fixed point has a closed form: order sources by cap / weight;
   the ones whose cap lies under the water level are capped.
2. The mix consists of blocks of ``block_words`` words.  They are allotted to
   sources by the highest quotients target / (2k + 1), then to the shards of
   every source by the highest quotients shard size / (2k + 1): integer quotas.
3. Inside a shard, documents stand in a seeded order and form a ring of words
   that is cut into blocks; the quota is taken from a seeded block on,
   round the ring.  A document's ``taken`` is what the blocks cover of it.

A source of any size is spread over shards of about ``rows_per_shard`` rows,
so no window ever holds a whole source.  Only per-source and per-shard sums
meet in global windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctlens.llm.common import WORD_PATTERN, stored

WEIGHTS = (3, 1, 2)


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
                   max_repeat: int = 2) -> DataFrame:
    """(source, source_size, ...) -> adds ``weight`` and ``target`` (double)."""
    everything = Window.partitionBy()
    by_code_point = everything.orderBy(F.col("source").asc_nulls_last())
    weighed = (sources
               .withColumn("turn", F.row_number().over(by_code_point) - 1)
               .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                  (F.col("turn") % len(weights) + 1).cast("int")))
               .withColumn("cap", F.col("source_size") * F.lit(float(max_repeat))))
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), "turn")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * F.lit(float(share))
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (weighed.withColumn("level", level)
            .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
            .withColumn("water", F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(whole))
            .withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("water") * F.col("weight")))
            .drop("turn", "cap", "level", "capped", "water"))


def apportion(df: DataFrame, votes: str, seats: str, within: list[str], order: list[str], out: str) -> DataFrame:
    """Sainte-Lague: ``out`` = the seats of every row among the rows that
    share ``within`` (``seats`` is the same on all of them).

    With n rows, the divisors V/(M-n) and V/(M+n) bracket the exact one, so all
    but at most 3n seats are settled by rounding; only those few quotients
    are ranked.  Ties go to the row that comes first in ``order``.
    """
    group = Window.partitionBy(*within)
    v, m = F.col(votes).cast("double"), F.col(seats)
    total, n = F.sum(v).over(group), F.count(F.lit(1)).over(group)
    rounded = lambda k: F.floor(v * k / F.col("_total") + 0.5)
    bracketed = (df.withColumn("_total", total).withColumn("_n", n)
                 .withColumn("_base", F.when((m > F.col("_n")) & (F.col("_total") > 0), rounded(m - F.col("_n")))
                             .otherwise(F.lit(0)).cast("long"))
                 .withColumn("_top", F.when((F.col("_total") > 0) & (m > 0), rounded(m + F.col("_n")))
                             .otherwise(F.col("_base")).cast("long"))
                 .withColumn("_left", m - F.sum("_base").over(group)))
    open_seats = (bracketed.filter("_top > _base")
                  .select(*within, *[c for c in order if c not in within], votes, "_left",
                          F.explode(F.sequence(F.col("_base") + 1, F.col("_top"))).alias("_seat")))
    ranked = open_seats.withColumn("_rank", F.row_number().over(
        group.orderBy((v / (F.col("_seat") * 2 - 1)).desc(), *[F.col(c).asc_nulls_last() for c in order])))
    keys = list(dict.fromkeys([*within, *order]))
    won = ranked.filter("_rank <= _left").groupBy(*keys).agg(F.count(F.lit(1)).alias("_won"))
    won = won.select(*[F.col(c).alias(f"_k_{c}") for c in keys], "_won")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return (bracketed.join(won, same, "left")
            .withColumn(out, F.col("_base") + F.coalesce("_won", F.lit(0)))
            .drop("_total", "_n", "_base", "_top", "_left", "_won", *[f"_k_{c}" for c in keys]))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_repeat: int = 2,
                block_words: int = 16, rows_per_shard: int = 4096, seed: int = 42) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source, ...) as struct ``doc``,
    plus size, source_size, target, taken, and where the taken words are:
    ``copies`` whole copies and the word ranges (part1_start, part1_words),
    (part2_start, part2_words), empty ones with 0 words.

    Null text: size 0, nothing taken.  Null source: a source of its own.
    Repeated rows: each takes part; rows that are alike in doc_id and text
    may swap places without changing the result.  Empty table: empty result.
    Further columns stay inside ``doc`` and can't clash.
    """
    size = docs.select(F.struct("*").alias("doc"), "doc_id", "source", word_count("text").alias("size"),
                       F.xxhash64(F.lit(seed), "doc_id").alias("turn"))
    sizes = stored(size.select("doc_id", "source", "size", "turn"), "mix_sizes")
    return _mixed(size, sizes, weights, share, max_repeat, block_words, rows_per_shard, seed)


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """``mix_sources`` without the documents themselves: (doc_id, size,
    source_size, target, taken, ...); the texts are read once and never
    shuffled."""
    sizes = stored(docs.select("doc_id", "source", word_count("text").alias("size"),
                               F.xxhash64(F.lit(options.get("seed", 42)), "doc_id").alias("turn")), "mix_sizes")
    o = {"weights": WEIGHTS, "share": 1.5, "max_repeat": 2, "block_words": 16, "rows_per_shard": 4096, "seed": 42} | options
    return _mixed(sizes, sizes, **o)


def _mixed(rows: DataFrame, sizes: DataFrame, weights, share, max_repeat, block_words, rows_per_shard, seed):
    block = F.lit(block_words)
    sources = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                         F.count(F.lit(1)).alias("source_rows")),
                             weights, share, max_repeat)
    sources = sources.withColumn("blocks", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long"))
    sources = apportion(sources, "target", "blocks", [], ["source"], "source_blocks")
    sources = sources.select("source", "source_size", "target", "source_blocks",
                             F.ceil(F.col("source_rows") / rows_per_shard).alias("shards"))
    sources = stored(sources, "mix_sources")

    def sharded(df):
        key = sources.withColumnRenamed("source", "_source")
        return (df.join(key, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
                .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.col("shards"))))

    shards = (sharded(sizes).groupBy("source", "shard")
              .agg(F.sum("size").alias("shard_size"), F.first("source_blocks").alias("source_blocks")))
    shards = apportion(shards, "shard_size", "source_blocks", ["source"], ["shard"], "quota")
    ring = F.col("shard_size")
    words = F.least(F.col("quota") * block, ring * max_repeat)
    shards = stored(shards.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "shard_size",
        F.when(ring > 0, F.expr("1")).otherwise(0).alias("any"), words.alias("words"),
        F.when(ring > 0, F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.ceil(ring / block)) * block)
        .otherwise(0).alias("from_word")), "mix_shards")
    in_shard = Window.partitionBy("source", "shard").orderBy("turn", "doc_id", "size")
    placed = (sharded(rows).withColumn("a", F.coalesce(
        F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(shards, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard"))))
    full = F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.greatest("shard_size", F.lit(1)))).otherwise(0)
    placed = (placed.withColumn("copies", F.when(F.col("size") > 0, full).otherwise(0).cast("long"))
              .withColumn("rest", F.col("words") - full * F.col("shard_size"))
              .withColumn("b", F.col("a") + F.col("size"))
              .withColumn("end1", F.least(F.col("from_word") + F.col("rest"), F.col("shard_size")))
              .withColumn("end2", F.greatest(F.col("from_word") + F.col("rest") - F.col("shard_size"), F.lit(0))))
    part1 = F.greatest(F.least("b", "end1") - F.greatest("a", "from_word"), F.lit(0))
    part2 = F.greatest(F.least("b", "end2") - F.col("a"), F.lit(0))
    placed = (placed.withColumn("part1_words", part1).withColumn("part2_words", part2)
              .withColumn("part1_start", F.greatest(F.col("from_word") - F.col("a"), F.lit(0)))
              .withColumn("part2_start", F.lit(0).cast("long"))
              .withColumn("taken", (F.col("copies") * F.col("size") + F.col("part1_words") + F.col("part2_words"))
                          .cast("long")))
    keep = ["doc"] if "doc" in rows.columns else ["doc_id"]
    return placed.select(*keep, "size", "source_size", "target", "taken", "copies", "part1_start", "part1_words",
                         "part2_start", "part2_words")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for every whole copy
    and for every cut piece; a piece holds its words joined by single spaces,
    and ``n_chars``, if there, is measured anew."""
    m = mix_sources(docs, **options)
    words = F.split(F.regexp_replace(F.col("doc.text"), r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    piece = lambda k: F.when(
        F.col(f"part{k}_words") > 0,
        F.array(F.array_join(F.slice(words, (F.col(f"part{k}_start") + 1).cast("int"),
                                     F.col(f"part{k}_words").cast("int")), " "))).otherwise(F.array().cast("array<string>"))
    whole = F.when(F.col("copies") > 0, F.array_repeat(F.col("doc.text"), F.col("copies").cast("int"))
                   ).otherwise(F.array().cast("array<string>"))
    out = m.filter("taken > 0").select("doc", F.explode(F.concat(whole, piece(1), piece(2))).alias("new_text"))
    return out.select(*[F.col("new_text").alias(c) if c == "text" else
                        F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
                        F.col(f"doc.`{c}`").alias(c) for c in docs.columns])

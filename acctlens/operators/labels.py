"""A lasting dictionary of labels, and cause mixes in sparse form.

Labels get ids once and keep them, so vectors of different batches compare.  The
labels that a batch brings are ranked by frequency, then by name, behind all
that came before: ranges of that order go to tasks, a task numbers its own, and one small
row a task gives the offsets.  No list of labels passes through the driver,
and a key has a row only for the labels it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctlens.operators.cause_mix import scope_keys
from acctlens.session import materialize
from acctlens.sinks.committed import CommittedTable

LABELS = "label string, id long, labelCount long"


def ranked(df: DataFrame, *order) -> DataFrame:
    """Adds ``rank`` (from 0) by ``order``, without one task that sees all rows."""
    at = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    tasks = at.groupBy(part).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)     # one row a task
    tasks = tasks.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return at.withColumn("_part", part).join(tasks, "_part").withColumn("rank", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


class LabelDictionary:
    """Append-only table (label, id, labelCount: rows in the batch that brought it)."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = CommittedTable(spark, path, LABELS)

    def read(self) -> DataFrame:
        return self.table.read()

    def add(self, labels: DataFrame, batch_id: int) -> bool:
        """Give ids to the labels (a row each time one occurs) that have none; null is no
        label.  A batch that is in already is left as it is."""
        known = sum(r.rows for r in self.table.records())       # ids are dense: no job needed
        counts = labels.select(F.col(labels.columns[0]).alias("label")).filter("label is not null") \
            .groupBy("label").agg(F.count(F.lit(1)).alias("labelCount"))
        new = counts.join(self.read().select("label"), "label", "left_anti")
        rows = ranked(new, F.col("labelCount").desc(), F.col("label")).select("label", (F.col("rank") + known).alias("id"), "labelCount")
        return self.table.write(rows, batch_id)


def sparse_mix(ratios: DataFrame, labels: DataFrame, scope: str = "window", digits: int | None = 9) -> DataFrame:
    """``keys, causeIndex (long), cause, ratioSum, minSumPerBras``: the mix vectors of
    :func:`acctlens.operators.cause_mix.cause_features`, a row for each entry that is
    there.  Rows whose cause has no id are left out."""
    keys = scope_keys(scope)
    sums = ratios.groupBy(*keys, "aggField2").agg(F.sum("ratioInBras").alias("ratioSum"), F.min("sumPerBras").alias("minSumPerBras"))
    found = sums.join(labels.select(F.col("label").alias("aggField2"), F.col("id").alias("causeIndex")), "aggField2")
    ratio = F.round("ratioSum", digits) if digits is not None else F.col("ratioSum")
    return found.select(*keys, "causeIndex", F.col("aggField2").alias("cause"), ratio.alias("ratioSum"),
                        F.min("minSumPerBras").over(Window.partitionBy(*keys)).alias("minSumPerBras"))

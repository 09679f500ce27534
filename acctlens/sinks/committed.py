"""Tables of micro-batches with a commit record per batch.

    <path>/data/folder=<folder>/...   files of one batch, or of a compacted range of batches
    <path>/commits/<record>           an empty file; what it says is its name

A record's name is ``<from batch>_<to batch>_<tier>_<rows>_<low>_<high>_<folder>``;
low and high bound the batch's event times in microseconds (``x``: none).  A batch's
files count only once its record exists, and the record appears at once and
whole, so a crash between write and commit leaves nothing visible, and a batch that
is retried after its commit is not written again.  One listing of the records says
what to read and, by their times, what to skip.

Every ``COMPACT`` batches are written together, a file for each day, under
a record that covers them all; so are every ``COMPACT`` of those, and so on.  A table of n
batches then has fewer than ``COMPACT`` folders of each tier, log(n) tiers.
Replaced folders stay for readers that have begun, until ``vacuum``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMPACT = 32
NONE = "x"


@dataclass(frozen=True, order=True)
class Record:
    first: int
    last: int
    tier: int
    rows: int
    low: int | None
    high: int | None
    folder: str

    @property
    def name(self) -> str:
        times = [NONE if t is None else str(t) for t in (self.low, self.high)]
        return "_".join([f"{self.first:012d}", f"{self.last:012d}", str(self.tier), str(self.rows), *times, self.folder])

    @classmethod
    def parse(cls, name: str) -> "Record":
        first, last, tier, rows, low, high, folder = name.split("_")
        return cls(int(first), int(last), int(tier), int(rows), None if low == NONE else int(low),
                   None if high == NONE else int(high), folder)


class CommittedTable:
    """``time`` is the event-time column, if any; rows are laid out by its day.

    ``by_day``: a batch's rows are dealt over the writers by day first, so that a batch of
    many days has a file or two for each instead of one for each day and writer; the batch is run
    through twice, so callers persist it."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, time: str | None = None, fmt: str = "parquet",
                 by_day: bool = False):
        self.spark, self.path, self.time, self.fmt, self.by_day = spark, path.rstrip("/"), time, fmt, by_day
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p}")
        self._fs = self._path("commits").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _data(self, folder: str) -> str:
        return f"{self.path}/data/folder={folder}"

    # ---- records ----
    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def all_records(self) -> list[Record]:
        return sorted(Record.parse(n) for n in self._names("commits"))

    def records(self) -> list[Record]:
        """What the table consists of: of records that overlap, the widest; of equal
        ranges, the first by name."""
        out: list[Record] = []
        for r in sorted(self.all_records(), key=lambda r: (r.first, -r.last, r.name)):
            if not out or r.first > out[-1].last:
                out.append(r)
        return out

    def _commit(self, record: Record) -> None:
        self._fs.mkdirs(self._path("commits"))
        self._fs.createNewFile(self._path(f"commits/{record.name}"))

    def newest(self) -> dt.datetime | None:
        """The greatest event time of all batches, from the records alone."""
        high = max((r.high for r in self.records() if r.high is not None), default=None)
        return None if high is None else dt.datetime.fromtimestamp(high // 1_000_000) + dt.timedelta(microseconds=high % 1_000_000)

    # ---- writing ----
    def _store(self, df: DataFrame, first: int, last: int, tier: int, rebalance: bool) -> Record:
        folder = uuid.uuid4().hex
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        if self.time:
            df = df.withColumn("_day", F.to_date(self.time))
            writers = max(1, self.spark.sparkContext.defaultParallelism)
            if rebalance:
                df = df.repartition(writers, "_day")
            elif self.by_day:  # neighbouring days to a writer; the rows of a large day to several
                df = df.repartitionByRange(writers, F.col("_day"), F.xxhash64(*self.schema.names))
        elif rebalance:
            df = df.coalesce(1)
        df.write.format(self.fmt).partitionBy(*(["_day"] if self.time else [])).save(self._data(folder))
        us = F.unix_micros(F.col(self.time).cast("timestamp")) if self.time else F.lit(None).cast("long")
        rows, low, high = self._load([folder]).agg(F.count(F.lit(1)), F.min(us), F.max(us)).first()
        return Record(first, last, tier, rows, low, high, folder)

    def write(self, df: DataFrame, batch_id: int) -> bool:
        """Write and commit a batch; False if it is committed already.  Then its rows
        are only run through: a stream's state stores commit as they are read."""
        if any(r.first <= batch_id <= r.last for r in self.all_records()):
            df.write.format("noop").mode("overwrite").save()
            return False
        self._commit(self._store(df, batch_id, batch_id, 0, False))
        self.compact()
        return True

    def compact(self, every: int = COMPACT) -> int:
        """Join runs of ``every`` folders of one tier; returns how many were made."""
        made, tier = 0, 0
        while True:
            live = self.records()
            run = [r for r in live if r.tier == tier][:every]
            if len(run) < every:
                if not any(r.tier > tier for r in live):
                    return made
                tier += 1
                continue
            # neighbours only: no other record may lie between
            inside = [r for r in live if run[0].first <= r.first <= run[-1].last]
            rows = self._load([r.folder for r in inside if r.rows])
            self._commit(self._store(rows, run[0].first, run[-1].last, tier + 1, True))
            made += 1

    def vacuum(self) -> int:
        """Delete records and folders that a wider record replaces, and folders that
        were never committed.  Only while nothing is being written or read."""
        live = self.records()
        keep = {r.folder for r in live}
        gone = [r for r in self.all_records() if r not in live]
        for r in gone:
            self._fs.delete(self._path(f"commits/{r.name}"), False)
        folders = [f for f in self._names("data") if f.removeprefix("folder=") not in keep]
        for f in folders:
            self._fs.delete(self._path(f"data/{f}"), True)
        return len(folders)

    # ---- reading ----
    def _load(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        schema = StructType(list(self.schema.fields)).add("folder", "string")
        if self.time:
            schema = schema.add("_day", "date")
        reader = self.spark.read.schema(schema).format(self.fmt).option("basePath", f"{self.path}/data")
        return reader.load([self._data(f) for f in folders])

    def read(self, since: dt.datetime | None = None, until: dt.datetime | None = None) -> DataFrame:
        """Committed rows, with event times from ``since`` to ``until`` (as ``newest`` and
        collected rows give them; without zone, local time): batches outside are not opened, nor days of the others."""
        lo, hi = (None if t is None else int(t.replace(microsecond=0).timestamp()) * 1_000_000 + t.microsecond for t in (since, until))
        chosen = [r for r in self.records() if r.rows
                  and not (r.high is not None and lo is not None and r.high < lo)
                  and not (r.low is not None and hi is not None and r.low > hi)]
        rows = self._load([r.folder for r in chosen])
        for us, inside in ((lo, lambda c, x: c >= x), (hi, lambda c, x: c <= x)):
            if chosen and us is not None:
                bound = F.timestamp_micros(F.lit(us))
                rows = rows.filter(inside(F.col("_day"), F.to_date(bound)) & inside(F.col(self.time), bound))
        return rows.select(*self.schema.names)

"""URL filter rules as a sort-merge range join.

A host is written with its labels reversed, each closed by a dot
(``www.example.org`` -> ``org.example.www.``).  A rule on ``example.org``
covers exactly the keys in the interval that starts at ``org.example.``: the
host and all its subdomains.  Intervals of rules nest or are disjoint, so one
sweep over keys in order keeps the rules that are open now on a stack; of these
the longest whose path is a prefix of the URL's path decides.

Rows go to range shards by (key, salt) with splitters from a bounded sample
(at most ``MAX_SHARDS * 16`` keys); the salt spreads a hot host, or a hot URL,
over shards.  Each shard is a partition of its own, so no two meet in one task.  A rule is sent
to the shards that its interval overlaps.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.common import batch

MAX_SHARDS = 4096
ROWS_PER_SHARD = 4096
LAST = "\U0010ffff"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OUT = pa.schema([("id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
                 ("verdict", pa.string())])


def host_and_path(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """(id, host, path, key): pieces of ``url``; both empty without ``://``."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    split = (pages.select(F.col(id_column).cast("long").alias("id"), rest.alias("rest"))
             .withColumn("raw", F.regexp_extract("rest", r"\A[^/?#]*", 0))
             .withColumn("host", F.translate("raw", UPPER, LOWER))
             .withColumn("path", F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), r"\A[^?#]*", 0)))
    return split.select("id", "host", "path", reversed_key(F.col("host")).alias("key"))


def reversed_key(host):
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def apply_rules(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``rules``: (host, path, verdict).  The longest rule (host and path
    together) wins, then the longer host, then ``block``.  Without a rule that
    fits: rule null, verdict ``default``.  A null URL or one without ``://``
    has an empty host and path, which no rule with a host fits.  Repeated rows
    and null ids are kept; an empty table gives an empty result; rules with a
    null part are ignored.
    """
    spark = pages.sparkSession
    urls = host_and_path(pages, id_column).withColumn("salt", F.xxhash64("id", "path"))
    rows = pages.count()
    n = min(MAX_SHARDS, max(1, -(-rows // ROWS_PER_SHARD)))
    cuts: list[tuple[str, int]] = []
    if n > 1:
        sample = urls.select("key", "salt").sample(min(1.0, 12 * n / rows), seed=7).limit(16 * n).collect()
        seen = sorted((r.key, r.salt) for r in sample)
        cuts = [seen[i * len(seen) // n] for i in range(1, n)] if seen else []
    low, high = -(1 << 63), 1 << 63
    url_in = pa.schema([("shard", pa.int32()), ("key", pa.string()), ("kind", pa.int32()), ("id", pa.int64()),
                        ("host", pa.string()), ("path", pa.string()), ("verdict", pa.string())])
    ddl = "shard int, key string, kind int, id long, host string, path string, verdict string"

    def place_urls(batches):
        for rb in batches:
            d = rb.to_pydict()
            shard = [bisect_right(cuts, x) for x in zip(d["key"], d["salt"])]
            yield batch(url_in, [shard, d["key"], [1] * len(shard), d["id"], d["host"], d["path"], [None] * len(shard)])

    def place_rules(batches):
        for rb in batches:
            out = []
            for key, host, path, verdict in zip(*rb.to_pydict().values()):
                for shard in range(bisect_left(cuts, (key, low)), bisect_right(cuts, (key + LAST, high)) + 1):
                    out.append((shard, key, 0, None, host, path, verdict))
            if out:
                yield batch(url_in, list(zip(*out)))

    rule_rows = (rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").dropna().distinct()
                 .select(reversed_key(F.col("host")).alias("key"), "host", "path", "verdict"))
    events = urls.mapInArrow(place_urls, ddl).unionByName(rule_rows.mapInArrow(place_rules, ddl))
    swept = (events.repartitionById(n, "shard").sortWithinPartitions("shard", "key", "kind", F.length("path"))
             .mapInArrow(lambda it: sweep(it, default),
                         "id long, host string, path string, rule string, verdict string"))
    return swept.withColumnRenamed("id", id_column)


def sweep(batches, default: str):
    """Events in key order; rules come before the URLs of their key."""
    stack: list[tuple[str, str, str, str, tuple]] = []
    now = None
    for rb in batches:
        out = []
        for shard, key, kind, id_, host, path, verdict in zip(*rb.to_pydict().values()):
            if shard != now:
                now, stack = shard, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, path, verdict, host + path, (len(host) + len(path), len(host), verdict == "block")))
                continue
            fits = [r for r in stack if path.startswith(r[1])]
            best = max(fits, key=lambda r: r[4]) if fits else None
            out.append((id_, host, path, best[3] if best else None, best[2] if best else default))
        if out:
            yield batch(OUT, list(zip(*out)))

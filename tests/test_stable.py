"""Label dictionary, mergeable moments, vector sums, the SQL function, cluster checks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctlens.functions.sql import register_sql_functions
from acctlens.operators import moments as mo
from acctlens.operators.ingest import cdr_tuple22
from acctlens.operators.labels import LabelDictionary, ranked, sparse_mix
from acctlens.operators.vector_sum import vector_sum
from acctlens.plans.queries import cluster_checks
from acctlens.session import scratch_path
from tests.conftest import lines_df


def dictionary(spark):
    return LabelDictionary(spark, scratch_path(spark, "test/labels", unique=True))


def words(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "w string")


def test_ids_are_stable_over_batches_and_retries(spark):
    d = dictionary(spark)
    ids = lambda: {r.label: r.id for r in d.read().collect()}
    assert d.add(words(spark, "b", "a", "b", "c", None, ""), 0)
    assert ids() == {"b": 0, "": 1, "a": 2, "c": 3}
    assert not d.add(words(spark, "zzz"), 0)
    d.add(words(spark, "c", "e", "d", "e"), 1)
    assert ids() == {"b": 0, "": 1, "a": 2, "c": 3, "e": 4, "d": 5}
    d.add(words(spark), 2)
    d.add(words(spark, "a"), 3)
    assert len(ids()) == 6


def test_a_million_labels_without_a_collect(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    for name in ("collect", "toPandas", "toLocalIterator", "take", "toArrow"):
        monkeypatch.setattr(DataFrame, name, lambda *a, **k: pytest.fail("rows went to the driver") if len(a[0].columns) < 3 else None)
    monkeypatch.setattr("acctlens.sinks.committed.CommittedTable._store", _store_without_collect)
    d = dictionary(spark)
    d.add(spark.range(1_000_000).select(F.format_string("label%07d", F.col("id")).alias("w")), 0)
    monkeypatch.undo()
    ids = d.read().agg(F.count("id"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
    assert tuple(ids) == (1_000_000, 1_000_000, 0, 999_999)
    assert d.read().filter("label <> format_string('label%07d', id)").count() == 0      # equally frequent: by name


def _store_without_collect(self, df, first, last, tier, rebalance):
    from acctlens.sinks.committed import Record
    df.select(*self.schema.names).write.parquet(self._data("f"))
    return Record(first, last, tier, 1_000_000, None, None, "f")


def test_rank_of_ties_and_empty(spark):
    got = ranked(spark.createDataFrame([("x",)] * 5 + [("a",)], "w string"), F.col("w")).collect()
    assert sorted(r["rank"] for r in got) == list(range(6)) and min(got, key=lambda r: r["rank"]).w == "a"
    assert ranked(spark.createDataFrame([], "w string"), F.col("w")).count() == 0


def test_sparse_mix_has_the_entries_that_are_there(spark):
    ratios = spark.createDataFrame([("s", "a", 0.5, 4), ("s", "b", 0.5, 4), ("s", "a", 0.25, 8), ("t", "b", 1.0, 1), ("t", "?", 1.0, 1)],
                                   "aggField1 string, aggField2 string, ratioInBras double, sumPerBras long")
    d = dictionary(spark)
    d.add(words(spark, "a", "b"), 0)
    got = sorted(map(tuple, sparse_mix(ratios, d.read(), "batch").collect()))
    assert got == [("s", 0, "a", 0.75, 4), ("s", 1, "b", 0.5, 4), ("t", 1, "b", 1.0, 1)]


def test_moments_merge_in_any_order_and_under_a_large_offset(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=1000) + 1e9
    df = spark.createDataFrame([(float(v), int(k)) for v, k in zip(x, rng.integers(0, 7, 1000))], "x double, b int")
    merged = mo.sample_stddev(mo.merged_moments(mo.batch_moments(df, "x", ["b"]))).first()
    assert merged["count"] == 1000 and merged["min"] == x.min() and merged["max"] == x.max()
    assert merged["mean"] == pytest.approx(x.mean(), rel=1e-15) and merged["stddev"] == pytest.approx(x.std(ddof=1), rel=1e-7)


def test_moments_of_nothing_one_and_null_values(spark):
    empty = spark.createDataFrame([], "x double, b int")
    assert mo.merged_moments(mo.batch_moments(empty, "x")).first()["count"] == 0
    one = mo.sample_stddev(mo.merged_moments(mo.batch_moments(spark.createDataFrame([(3.0,), (None,)], "x double"), "x"))).first()
    assert (one["count"], one["mean"], one["deviation"], one["stddev"]) == (1, 3.0, 0.0, None)
    assert mo.beyond_sigmas(spark.createDataFrame([(3.0,)], "distanceFromCenter double"),
                            mo.merged_moments(mo.batch_moments(empty, "x"))).count() == 0


def test_vector_sum_of_unequal_empty_and_null_vectors(spark):
    rows = [("a", [1.0, 2.0, 3.0]), ("a", [10.0, 20.0]), ("a", []), ("a", None), ("b", []), ("c", None), (None, [1.0, None]), (None, [2.0, 5.0])]
    got = {r.k: r["sum"] for r in vector_sum(spark.createDataFrame(rows, "k string, v array<double>"), ["k"], "v").collect()}
    assert got == {"a": [11.0, 22.0], "b": [], "c": [], None: [3.0, 5.0]}
    assert vector_sum(spark.createDataFrame([], "k string, v array<double>"), ["k"], "v").count() == 0


def brute_vector_sum(vectors):
    total = []
    for v in vectors:
        if v:
            total = [a + b for a, b in zip(total, v)] if total else list(v)
    return total


def test_vector_sum_against_pairwise_sums(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), [float(x) for x in rng.integers(0, 9, rng.integers(0, 6) if k < 5 else 3)]) for k in rng.integers(0, 9, 200)]
    got = {r.k: r["sum"] for r in vector_sum(spark.createDataFrame(rows, "k int, v array<double>"), ["k"], "v").collect()}
    assert got == {k: brute_vector_sum([v for q, v in rows if q == k]) for k in got}


def test_sql_function_equals_the_parser_and_runs_without_python(spark):
    good = "2019/12/04 00:00:05,1575417605,Alive,S1, 5 ,5.7,0,2000,0,10,20,bras01,10.0.0.1,7,C1,1,user1,NODE7 atm 0/1,,rem,100.64.0.1,conn,,0,0,0,,"
    rows = [good, good.replace("2019/12/04 00:00:05", "2019-1-4 0:0:5.25"), good.replace("2019/12/04 00:00:05", "2019/12/04"), "a,b", "", good + ",more"]
    df = lines_df(spark, rows)
    register_sql_functions(spark)
    df.createOrReplaceTempView("some_lines")
    got = spark.sql("SELECT items.* FROM (SELECT toCDRItems(value) AS items FROM some_lines) WHERE items IS NOT NULL")
    want = cdr_tuple22(df)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect()) and got.count() == 3
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert spark.sql("SELECT toCDRItems(NULL) AS x").first().x is None


def test_a_random_split_turns_the_cluster_checks_red(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(20, 3)), rng.normal(size=(20, 3)) + 6])
    places = spark.createDataFrame([(str(i), j, float(v)) for i, row in enumerate(x) for j, v in enumerate(row)], "k string, place int, x double")

    def run(labels):
        centres = {c: x[labels == c].mean(axis=0) for c in set(labels.tolist())}
        rows = [(str(i), int(c), float(((x[i] - centres[c]) ** 2).sum())) for i, c in enumerate(labels.tolist())]
        return cluster_checks(places, spark.createDataFrame(rows, "k string, prediction int, distanceFromCenter double"), ["k"]).collect()

    right = run(np.repeat([0, 1], 20))
    assert all(r.centreIsMean and r.ownIsNearest and r.costNotAboveOne and r.clusters == 2 for r in right) and len(right) == 40
    split = run(rng.integers(0, 2, 40))
    assert all(r.centreIsMean for r in split) and not all(r.ownIsNearest for r in split)
    assert {r.clusters for r in run(np.zeros(40, int))} == {1}

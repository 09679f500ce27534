"""Cause mix, clustering and the sigma rule (G4, G10) plus invariants."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from acctlens.operators import cause_mix as cm
from acctlens.operators import outliers as ol
from acctlens.functions.vectors import vector_to_array

T = dt.datetime(2024, 1, 2)


def _stops(spark, rows):
    return spark.createDataFrame([("agg", T, v, b, c) for b, c, v in rows],
                                 "aggName string, timestamp timestamp, value long, aggField1 string, aggField2 string")


G4 = [("a", "U", 6), ("a", "L", 2), ("b", "U", 1), ("b", "I", 9), ("c", "U", 5), ("c", "L", 1)]


def _features(spark, rows=G4, scope="window", labels=None):
    ratios = cm.cause_ratio(_stops(spark, rows), scope)
    model = cm.fit_features(ratios, labels)
    return ratios, model, cm.cause_features(ratios, model, scope)


def test_g4_features(spark):
    ratios, model, feats = _features(spark)
    assert cm.model_labels(model) == ["U", "L", "I"]
    got = {r.aggField1: (r.features.toArray(), r.minSumPerBras) for r in feats.collect()}
    np.testing.assert_allclose(got["a"][0], [0.75, 0.25, 0])
    np.testing.assert_allclose(got["b"][0], [0.1, 0, 0.9])
    np.testing.assert_allclose(got["c"][0], [5 / 6, 1 / 6, 0])
    assert {k: v[1] for k, v in got.items()} == {"a": 8, "b": 10, "c": 6}
    # ratios of a key sum to one
    sums = ratios.groupBy("aggField1", "timestamp").agg(F.sum("ratioInBras").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-12 for r in sums)


def test_fixed_labels_and_batch_scope(spark):
    rows = G4 + [("a", "U", 4)]
    stops = _stops(spark, rows[:-1]).union(
        spark.createDataFrame([("agg", T + dt.timedelta(days=1), 4, "a", "U")], _stops(spark, G4).schema))
    for scope, expect_a in (("batch", [10 / 12, 2 / 12, 0, 0]), ("window", None)):  # the last place is of unknown causes
        ratios = cm.cause_ratio(stops, scope)
        model = cm.fit_features(ratios, ["U", "L", "I"])
        feats = cm.cause_features(ratios, model, scope)
        if scope == "batch":
            a = feats.filter(F.col("aggField1") == "a").first().features.toArray()
            np.testing.assert_allclose(a, expect_a)
        else:
            assert feats.filter(F.col("aggField1") == "a").count() == 2


def test_g4_kmeans_invariants(spark):
    _, _, feats = _features(spark)
    decorated, outl = ol.kmeans_outliers(feats, 2, 1, 2.0)
    rows = decorated.collect()
    pts = {r.aggField1: r.features.toArray() for r in rows}
    pred = {r.aggField1: r.prediction for r in rows}
    assert pred["a"] == pred["c"] != pred["b"]
    dist = {r.aggField1: r.distanceFromCenter for r in rows}
    assert abs(dist["a"] - 0.00347222222) < 1e-9 and abs(dist["c"] - 0.00347222222) < 1e-9
    assert abs(dist["b"]) < 1e-12
    # each centre is the mean of its members
    centre_ac = (pts["a"] + pts["c"]) / 2
    np.testing.assert_allclose(centre_ac, [0.7916666666, 0.2083333333, 0], atol=1e-9)
    assert outl.count() == 0          # three points can never pass the 2-sigma rule


def test_kmeans_guards(spark):
    _, _, one = _features(spark, [("a", "U", 1)])
    assert ol.kmeans_outliers(one, 2, 1) == (None, None)
    _, _, same = _features(spark, [("a", "U", 1), ("b", "U", 3)])
    decorated, _ = ol.kmeans_outliers(same, 2, 1)
    assert decorated.count() == 2
    assert all(r.distanceFromCenter == 0.0 for r in decorated.collect())


def test_g10_sigma_rule(spark):
    six = spark.createDataFrame([(float(x),) for x in [0, 0, 0, 0, 0, 1]], "distanceFromCenter double")
    assert [r.distanceFromCenter for r in ol.sigma_outliers(six, 2.0).collect()] == [1.0]
    five = spark.createDataFrame([(float(x),) for x in [0, 0, 0, 0, 1]], "distanceFromCenter double")
    assert ol.sigma_outliers(five, 2.0).count() == 0
    single = spark.createDataFrame([(1.0,)], "distanceFromCenter double")
    assert ol.sigma_outliers(single, 2.0).count() == 0


def test_mean_centre_distance(spark):
    _, _, feats = _features(spark)
    d = {r.aggField1: r.distanceFromCenter for r in ol.distance_to_mean_centre(feats).collect()}
    arr = {r.aggField1: np.array(r.a) for r in feats.select("aggField1", vector_to_array("features").alias("a")).collect()}
    centre = np.mean(list(arr.values()), axis=0)
    for k, v in arr.items():
        assert abs(d[k] - float(((v - centre) ** 2).sum())) < 1e-12


def test_long_form_and_top(spark):
    _, model, feats = _features(spark)
    long = cm.features_long(feats, cm.model_labels(model))
    assert long.count() == 9
    assert cm.first_keys(feats, 2).count() == 2

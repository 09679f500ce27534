"""The named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each runs over the whole ``events`` table rendered as accounting lines
(``acctlens.sources.events``) with the scaled cadences of
``acctlens.config.SCALED_CONFIG``.  ``acctlens.plans.oracle`` holds the
matching SQL.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlens.functions.sql import register_sql_functions
from acctlens.functions.vectors import vector_to_array
from acctlens.functions.scalars import access_node_adsl, access_node_fiber
from acctlens.operators import anomaly, cause_mix as cm, first_order as fo, ingest, outliers as ol
from acctlens.operators import labels as lb, moments as mo
from acctlens.operators import second_order as so
from acctlens.operators import replay as rp
from acctlens.operators.vector_sum import vector_sum
from acctlens.session import materialize, scratch_path
from acctlens.sources.minute_files import minute_file_lines, write_minute_files
from acctlens.sinks.committed import CommittedTable
from acctlens.streaming import jobs
from acctlens.streaming.late import LateSplit
from acctlens.streaming.minutes import LINES, lines_of_table, replay_stream
from acctlens.plans.common import CFG, lines, records, to_output
from acctlens.sinks.documents import index_documents_1, index_documents_2

Query = Callable[[SparkSession, str], DataFrame]

# longest gap of a replayed leaf, stretched to the tables' rate of a line in some tens of minutes
MINUTE_FILES_MAX_MISSING = 240
# replay parameters for the test tables (events start 2024-01-01)
# events begin two days earlier: those records are due at once
REPLAY_START = dt.datetime(2024, 1, 3, 0, 0)
REPLAY_START_TEXT = "2024-01-01T00-00"
REPLAY_REAL_START = dt.datetime(2026, 1, 1, 0, 0)
REPLAY_FACTOR = 10


def q_parse_cdr(spark, sf_dir):
    return to_output(records(spark, sf_dir, "cdr24"))


def q_parse_cdr_full(spark, sf_dir):
    return to_output(records(spark, sf_dir, "cdr28"))


def q_cdr_tuple22(spark, sf_dir):
    return to_output(records(spark, sf_dir, "cdr22"))


def q_quarantine(spark, sf_dir):
    return ingest.quarantine(lines(spark, sf_dir))


def q_access_node(spark, sf_dir):
    r = records(spark, sf_dir)
    return r.select("acctSessionId", "callingStationId", "circuitId",
                    access_node_adsl("callingStationId").alias("adslNode"),
                    access_node_fiber("circuitId").alias("fiberNode"), "accessNode")


def alive(spark, sf_dir):
    return fo.alive_counts(records(spark, sf_dir), CFG)


def stop_causes(spark, sf_dir):
    return fo.stop_cause_counts(records(spark, sf_dir), CFG)


def stats(spark, sf_dir):
    return so.second_order_stats(alive(spark, sf_dir), CFG)


def q_alive_count(spark, sf_dir):
    return to_output(alive(spark, sf_dir))


def q_alive_count_filled(spark, sf_dir):
    return to_output(fo.fill_silent_windows(alive(spark, sf_dir), CFG.bras_agg1_seconds))


def q_stop_cause_count(spark, sf_dir):
    return to_output(stop_causes(spark, sf_dir))


def q_first_order_3(spark, sf_dir):
    return to_output(fo.first_order(records(spark, sf_dir), ["nasIpAddress", "accessNode", "acctStatusType"],
                                    CFG.bras_agg1_seconds, "agg1_cdr_bras_node_status"))


def q_first_order_4(spark, sf_dir):
    return to_output(fo.first_order(records(spark, sf_dir),
                                    ["nasIpAddress", "accessNode", "accessType", "terminateCause"],
                                    CFG.term_cause_agg1_seconds, "agg1_cdr_stop_bras_node_type_cause",
                                    status="Stop"))


def q_agg_lines(spark, sf_dir):
    return fo.agg_lines(alive(spark, sf_dir))


def q_agg_line_roundtrip(spark, sf_dir):
    parsed = ingest.parse_agg_line(fo.agg_lines(alive(spark, sf_dir)), 1)
    return to_output(parsed.filter(F.col("aggName") == fo.ALIVE_AGG_NAME))


def q_second_order_values(spark, sf_dir):
    raw = so.second_order_values(alive(spark, sf_dir), CFG)
    return to_output(raw.select(F.col("window.end").alias("timestamp"), "aggField1",
                                F.array_join("values", ",").alias("values"),
                                F.array_join(so.zero_filled(), ",").alias("filledValues"),
                                F.size("values").alias("samples"), "sampleSize"))


def q_second_order_stats(spark, sf_dir):
    return to_output(stats(spark, sf_dir))


def q_second_order_exact(spark, sf_dir):
    return to_output(so.second_order_stats(alive(spark, sf_dir), CFG, exact=True)
                     .withColumn("mean", F.round("mean", 9)).withColumn("stdDev", F.round("stdDev", 9)))


def q_second_order_list_stats(spark, sf_dir):
    return to_output(so.stats_from_values(so.second_order_values(alive(spark, sf_dir), CFG)))


def alive_and_stats(spark, sf_dir):
    """Stage-1 counts are written once (checkpoint) and feed both the stats
    and the lookup side, so the raw lines are scanned once; the counts are
    orders of magnitude smaller than the lines."""
    counts = materialize(alive(spark, sf_dir))
    return counts, so.second_order_stats(counts, CFG)


def q_latest_stats(spark, sf_dir):
    counts, st = alive_and_stats(spark, sf_dir)
    return to_output(anomaly.latest_stats(counts, st, CFG, how="left"))


def q_alive_anomalies(spark, sf_dir):
    counts, st = alive_and_stats(spark, sf_dir)
    return to_output(anomaly.alive_anomalies(counts, st, CFG))


def q_index_docs_1(spark, sf_dir):
    return index_documents_1(alive(spark, sf_dir))


def q_index_docs_2(spark, sf_dir):
    return index_documents_2(stats(spark, sf_dir))


def ratios(spark, sf_dir, scope="window", checkpoint=True):
    df = cm.cause_ratio(stop_causes(spark, sf_dir), scope)
    return materialize(df) if checkpoint else df


def mix(spark, sf_dir, scope="window"):
    """(ratios, fitted feature model, features).  The ratios are written to
    the checkpoint folder once: the indexer fit and the transform both read
    them, and neither re-scans the raw lines."""
    r = ratios(spark, sf_dir, scope)
    model = cm.fit_features(r)
    return r, model, cm.cause_features(r, model, scope)


def q_cause_ratio(spark, sf_dir):
    return to_output(ratios(spark, sf_dir, "window", checkpoint=False))


def q_cause_ratio_batch(spark, sf_dir):
    return to_output(ratios(spark, sf_dir, "batch", checkpoint=False))


def q_cause_index(spark, sf_dir):
    r, model, _ = mix(spark, sf_dir)
    return cm.label_index(r, model)


def q_cause_mix(spark, sf_dir):
    _, model, feats = mix(spark, sf_dir)
    return to_output(cm.features_long(feats, cm.model_labels(model)))


def q_cause_mix_batch(spark, sf_dir):
    _, model, feats = mix(spark, sf_dir, "batch")
    return cm.features_long(feats, cm.model_labels(model), "batch")


def q_cause_mix_top30(spark, sf_dir):
    _, model, feats = mix(spark, sf_dir)
    top = cm.first_keys(feats, 30)
    return to_output(cm.features_long(feats.join(top, ["aggField1", "timestamp"], "left_semi"),
                                      cm.model_labels(model)))


def _rounded(df, cols, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def mean_centre_distances(spark, sf_dir):
    _, _, feats = mix(spark, sf_dir)
    return ol.distance_to_mean_centre(feats).select("aggField1", "timestamp", "distanceFromCenter")


def q_centre_distance(spark, sf_dir):
    return to_output(_rounded(mean_centre_distances(spark, sf_dir), ["distanceFromCenter"]))


def q_distance_summary(spark, sf_dir):
    return _rounded(ol.distance_summary(mean_centre_distances(spark, sf_dir)), ["mean", "stddev", "min", "max"])


def q_sigma_outliers(spark, sf_dir):
    out = ol.sigma_outliers(mean_centre_distances(spark, sf_dir), CFG.outlier_sigmas)
    return to_output(_rounded(out, ["distanceFromCenter"]))


def _kmeans(spark, sf_dir):
    _, _, feats = mix(spark, sf_dir)
    feats = materialize(feats)  # read by the guard, the fit and the result
    return ol.kmeans_outliers(feats, CFG.kmeans_k, CFG.kmeans_seed, CFG.outlier_sigmas)


def cluster_checks(places, assigned, keys):
    """Checks of a clustering, all worked out anew from the vectors.

    ``places``: keys, place, x; ``assigned``: keys, prediction, distanceFromCenter.
    Per row: whether the distance is that to the mean of its cluster, and whether no
    other cluster's mean is nearer; for all rows: the number of clusters, and whether
    their cost is not above that of one cluster."""
    own = places.join(assigned, keys)
    centres = own.groupBy("prediction", "place").agg(F.avg("x").alias("c"))
    away = (places.join(centres.withColumnRenamed("prediction", "cluster"), "place")   # rows x clusters
            .groupBy(*keys, "cluster").agg(F.count(F.lit(1)).alias("causes"), F.sum((F.col("x") - F.col("c")) ** 2).alias("d")))
    judged = (away.join(assigned, keys).groupBy(*keys, "prediction", "distanceFromCenter", "causes")
              .agg(F.min("d").alias("least"), F.max(F.when(F.col("cluster") == F.col("prediction"), F.col("d"))).alias("d")))
    one = places.groupBy("place").agg((F.var_pop("x") * F.count("x")).alias("v")).agg(F.sum("v")).scalar()
    cost = judged.agg(F.sum("d"), F.countDistinct("prediction").alias("n"))
    near = 1e-7
    return judged.select(
        *keys, F.col("causes").cast("int").alias("causes"), (F.abs(F.col("distanceFromCenter") - F.col("d")) < near).alias("centreIsMean"),
        (F.col("d") <= F.col("least") + near).alias("ownIsNearest"), cost.select("n").scalar().cast("int").alias("clusters"),
        (cost.select("sum(d)").scalar() <= one + near).alias("costNotAboveOne"))


def q_kmeans_distance(spark, sf_dir):
    decorated, _ = _kmeans(spark, sf_dir)
    keys = ["aggField1", "timestamp"]
    places = decorated.select(*keys, F.posexplode(vector_to_array("features")).alias("place", "x"))
    return to_output(cluster_checks(places, decorated.select(*keys, "prediction", "distanceFromCenter"), keys))


def q_kmeans_outliers(spark, sf_dir):
    """Every row with whether its outlier flag is the rule's, worked out anew
    from the sums of distances and of their squares."""
    decorated, out = _kmeans(spark, sf_dir)
    keys = ["aggField1", "timestamp"]
    flagged = decorated.join(out.select(*keys, F.lit(True).alias("flag")), keys, "left").fillna(False, ["flag"])
    return to_output(_rule_checks(flagged, keys, "flag"))


def _rule_checks(flagged, keys, flag):
    d = F.col("distanceFromCenter").cast("decimal(30,18)")
    sums = flagged.agg(F.count(F.lit(1)).alias("n"), F.sum(d).cast("double").alias("s"), F.sum(F.col("distanceFromCenter") ** 2).alias("q"))
    limit = sums.select(F.col("s") / F.col("n") + F.lit(CFG.outlier_sigmas) * F.sqrt(
        (F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1))).scalar()
    near = F.abs(F.col("distanceFromCenter") - F.col("limit")) < 1e-9
    return flagged.withColumn("limit", limit).select(
        *keys, (near | (F.col(flag) == (F.col("distanceFromCenter") > F.col("limit")))).alias("flagIsTheRule"))


BATCHES = 6


def _batch_of(time):
    """Stand-in micro-batches: a week of window ends each, the last with all that follow."""
    return F.greatest(F.lit(0), F.least(F.floor(F.datediff(time, F.lit("2024-01-01")) / 7), F.lit(BATCHES - 1))).cast("long")


def _moments(spark, sf_dir):
    """(distances, merged moments of weekly batches that were written one by one)."""
    distances = materialize(mean_centre_distances(spark, sf_dir).withColumn("batch", _batch_of("timestamp")))
    kept = CommittedTable(spark, scratch_path(spark, "moments", unique=True), mo.MOMENTS)
    for batch in range(BATCHES):
        kept.write(mo.batch_moments(distances.filter(F.col("batch") == batch), "distanceFromCenter"), batch)
    return distances, mo.merged_moments(kept.read())


def q_distance_summary_merged(spark, sf_dir):
    _, merged = _moments(spark, sf_dir)
    return _rounded(mo.sample_stddev(merged).drop("deviation"), ["mean", "stddev", "min", "max"])


def q_sigma_outliers_merged(spark, sf_dir):
    """The sigma rule over all batches from their moments."""
    distances, merged = _moments(spark, sf_dir)
    return to_output(_rounded(mo.beyond_sigmas(distances, merged, CFG.outlier_sigmas).drop("batch"), ["distanceFromCenter"]))


def q_cause_mix_stable(spark, sf_dir):
    """Mixes over a lasting dictionary: stop counts by server and client come in two
    batches, the second with labels that the first has not."""
    counts = fo.first_order(records(spark, sf_dir), ["nasIpAddress", "clientId"], CFG.term_cause_agg1_seconds,
                            fo.STOP_CAUSE_AGG_NAME, status="Stop")
    ratios_ = materialize(cm.cause_ratio(counts).withColumn("batch", F.least(_batch_of("timestamp"), F.lit(1))))
    labels, mixes = lb.LabelDictionary(spark, scratch_path(spark, "labels", unique=True)), []
    for batch in range(2):
        part = ratios_.filter(F.col("batch") == batch)
        labels.add(part.select("aggField2"), batch)
        mixes.append(materialize(lb.sparse_mix(part, labels.read())))
    return to_output(mixes[0].unionByName(mixes[1]))


def q_vector_sum(spark, sf_dir):
    """Sums of vectors of unequal length, some empty or null, by server and access type."""
    n = F.substring("acctSessionId", 2, 20).cast("long")
    length = F.when(n % 5 == 0, 0).when((n % 7 == 0) & (F.col("accessType") != "0"), 3).otherwise(4)
    v = F.slice(F.array("sessionTime", "outputOctets", "inputOctets", "outputGigawords"), F.lit(1), length)
    rows = records(spark, sf_dir).select("nasIpAddress", "accessType", F.when(n % 13 != 0, v).alias("v"))
    sums = vector_sum(rows, ["nasIpAddress", "accessType"], "v")
    return sums.select("nasIpAddress", "accessType", F.posexplode("sum").alias("place", "total"))


def q_sql_cdr_items(spark, sf_dir):
    """SQL text over a view of lines, with the parser as a SQL function."""
    register_sql_functions(spark)
    lines(spark, sf_dir).createOrReplaceTempView("cdr_lines")
    return to_output(spark.sql("SELECT items.* FROM (SELECT toCDRItems(value) AS items FROM cdr_lines) WHERE items IS NOT NULL"))


def q_stream_sql_counts(spark, sf_dir):
    """The older micro-batch form: each batch is a view that SQL text counts."""
    register_sql_functions(spark)
    out = CommittedTable(spark, scratch_path(spark, "streams/sql_counts", unique=True), "acctStatusType string, total long")

    def run(batch, batch_id):
        batch.createOrReplaceTempView("arrived_lines")
        out.write(batch.sparkSession.sql(
            "SELECT items.acctStatusType, count(*) AS total FROM (SELECT toCDRItems(value) AS items FROM arrived_lines) "
            "WHERE items IS NOT NULL GROUP BY items.acctStatusType"), batch_id)

    jobs.with_batches(jobs.event_line_stream(spark, sf_dir, 2), run, scratch_path(spark, "streams/_ck", unique=True)).awaitTermination()
    return out.read().groupBy("acctStatusType").agg(F.sum("total").alias("total"))


def rebased(spark, sf_dir):
    return rp.rebase_lines(lines(spark, sf_dir), REPLAY_START, REPLAY_REAL_START, REPLAY_FACTOR)


def q_replay_rebase(spark, sf_dir):
    return to_output(rebased(spark, sf_dir).select("releaseTime", "value"))


def q_replay_publish(spark, sf_dir):
    return to_output(rp.publish_records(rebased(spark, sf_dir)))


def q_replay_quarantine(spark, sf_dir):
    return rp.replay_quarantine(lines(spark, sf_dir))


def q_minute_files(spark, sf_dir):
    """Lines written as leaf/day folders under the checkpoint root, then read
    back the way a replay from the first minute would read them."""
    root = scratch_path(spark, "minute_files", unique=True)
    write_minute_files(lines(spark, sf_dir), root)
    return to_output(minute_file_lines(spark, root, REPLAY_START_TEXT, "partitioned", MINUTE_FILES_MAX_MISSING))


# the minutes of these days arrive after all others
LATE_DAYS = ("2024-01-08", "2024-01-13")


def q_stream_minute_files(spark, sf_dir):
    """The same replay as a stream: the present minutes arrive in five batches,
    those of some days only in the last; lines are committed as minutes are released."""
    root = scratch_path(spark, "minute_stream", unique=True)
    write_minute_files(lines(spark, sf_dir), f"{root}/recorded")
    present = spark.read.schema("leaf string, minute timestamp").parquet(f"{root}/recorded/minutes")
    late = F.to_date("minute").between(*LATE_DAYS)
    turn = F.when(late, 4).otherwise(F.least(F.floor(F.datediff("minute", F.lit(REPLAY_START.date())) / 7), F.lit(3)))
    arrival = F.greatest(turn, F.lit(0)).alias("arrival")
    for n in range(5):
        present.filter(arrival == n).coalesce(1).write.mode("append").parquet(f"{root}/arrived")
    arrived = spark.readStream.schema("leaf string, minute timestamp").option("maxFilesPerTrigger", 1).parquet(f"{root}/arrived")
    out = CommittedTable(spark, f"{root}/replayed", LINES, "minute")
    replay_stream(arrived.withColumn("path", F.lit(None)), REPLAY_START_TEXT, out, f"{root}/_ck", lines_of_table(f"{root}/recorded"),
                  MINUTE_FILES_MAX_MISSING).awaitTermination()
    return to_output(out.read())


def _stream_records(spark, sf_dir, files: int | None = None):
    return ingest.parse_cdr(jobs.event_line_stream(spark, sf_dir, files))


def _run_to_table(spark, df, tag):
    root = scratch_path(spark, f"streams/{tag}", unique=True)
    jobs.to_table(df, f"{root}/out", f"{root}/_ck").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def q_stream_alive_count(spark, sf_dir):
    """Streamed Alive counts: the windows closed by the final watermark."""
    records = _stream_records(spark, sf_dir, files=1)
    return to_output(_run_to_table(spark, fo.alive_counts(records, CFG, streaming=True), "alive_count"))


def q_stream_restart(spark, sf_dir):
    """Streamed Alive counts on a processing-time trigger: the query is stopped after
    some micro-batches and started again from its checkpoint."""
    root = scratch_path(spark, "streams/restart", unique=True)
    out = jobs.output(spark, root, "counts")
    counts = fo.alive_counts(_stream_records(spark, sf_dir, files=1), CFG, streaming=True)

    def start():
        return jobs.with_batches(counts, lambda batch, n: out.write(batch, n) and None, f"{root}/_ck", trigger_seconds=1)

    query = start()
    while query.isActive and (query.lastProgress is None or query.lastProgress.batchId < 2):
        time.sleep(0.2)
    query.stop()
    query = start()
    query.processAllAvailable()
    query.stop()
    return to_output(out.read())


# stand-in arrivals: a file of records for each span of days, every few of them some spans late
ARRIVAL_DAYS, ARRIVALS, LATE_EVERY, LATE_BY = 6, 6, 7, 2


def q_stream_late_rows(spark, sf_dir):
    """Every record with whether it came too late for its windows: records arrive in
    six files, some in a later one than their time says."""
    root = scratch_path(spark, "streams/late", unique=True)
    rows = records(spark, sf_dir).select("date", "acctSessionId", "acctStatusType", "nasIpAddress")
    span = F.floor(F.datediff("date", F.lit("2024-01-01")) / ARRIVAL_DAYS)
    held = F.when(F.substring("acctSessionId", 2, 20).cast("long") % LATE_EVERY == 0, LATE_BY).otherwise(0)
    arrival = F.least(F.greatest(span, F.lit(0)) + held, F.lit(ARRIVALS - 1))
    recorded = materialize(rows.withColumn("arrival", arrival))
    for n in range(ARRIVALS):
        recorded.filter(F.col("arrival") == n).drop("arrival").coalesce(1).write.mode("append").parquet(f"{root}/arrived")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/arrived")
    split = LateSplit(spark, f"{root}/out", rows.schema, "date", CFG.bras_agg1_seconds, CFG.alive_watermark_seconds)
    jobs.with_batches(stream, split, f"{root}/_ck").awaitTermination()
    on_time = split.on_time.read().withColumn("watermark", F.lit(None).cast("timestamp")).withColumn("late", F.lit(False))
    return to_output(on_time.unionByName(split.late.read().withColumn("late", F.lit(True))))


def q_stream_stop_cause(spark, sf_dir):
    records = _stream_records(spark, sf_dir, files=1)
    return to_output(_run_to_table(spark, fo.stop_cause_counts(records, CFG, streaming=True), "stop_cause"))


def q_stream_second_order(spark, sf_dir):
    """Stage 1 and stage 2 chained in one streaming query."""
    return to_output(_run_to_table(spark, jobs.chained_stats(_stream_records(spark, sf_dir), CFG), "second_order"))


def q_stream_second_order_batches(spark, sf_dir):
    """The same over one line file a micro-batch, in event-time order."""
    records = _stream_records(spark, sf_dir, files=1)
    return to_output(_run_to_table(spark, jobs.chained_stats(records, CFG), "second_order_batches"))


def q_stream_hop_second_order(spark, sf_dir):
    """Two queries joined by an aggregate-line folder (the topic hop)."""
    root = scratch_path(spark, "streams/hop", unique=True)
    jobs.hop_first_stage(_stream_records(spark, sf_dir, files=1), CFG, f"{root}/agg_lines", f"{root}/_ck1").awaitTermination()
    stats = jobs.hop_second_stage(spark.readStream.format("text").load(f"{root}/agg_lines"), CFG)
    return to_output(_run_to_table(spark, stats, "hop_stats"))


def _analyzer(spark, sf_dir, *only, lines=None, files=2, **options):
    """The analyzer as it is deployed, or some queries of it, over line files in
    event-time order; returns the folder of its outputs."""
    root = scratch_path(spark, "streams/analyzer", unique=True)
    lines = jobs.event_line_stream(spark, sf_dir, files) if lines is None else lines
    if only:
        options["only"] = only
    for q in jobs.run_analyzer(spark, lines, CFG, root, trigger=False, **options):
        q.awaitTermination()
    return root


def q_stream_bad_sessions(spark, sf_dir):
    """Micro-batch cause mix (reference batch scope), all closed windows in one batch."""
    return jobs.output(spark, _analyzer(spark, sf_dir, "bad_sessions", files=None), "cause_mix").read()


def q_stream_kmeans_outliers(spark, sf_dir):
    """Micro-batch k-means predictions: each server with whether its
    sigma-outlier flag is the rule's."""
    root = _analyzer(spark, sf_dir, "bad_sessions", files=None)
    preds = jobs.output(spark, root, "predictions").read()
    flagged = jobs.output(spark, root, "outliers").read().select("aggField1", F.lit(True).alias("flag"))
    return _rule_checks(preds.join(flagged, ["aggField1"], "left").fillna(False, ["flag"]), ["aggField1"], "flag")


def q_stream_kmeans_distance(spark, sf_dir):
    """Micro-batch clusters checked against the vectors that were committed with them."""
    root = _analyzer(spark, sf_dir, "bad_sessions", files=None)
    places = jobs.output(spark, root, "cause_mix").read().select("aggField1", F.col("causeIndex").alias("place"), F.col("ratioSum").alias("x"))
    return cluster_checks(places, jobs.output(spark, root, "predictions").read(), ["aggField1"])


def q_stream_alive_anomalies(spark, sf_dir):
    """Anomalies that the running analyzer finds, all of its queries at once."""
    return to_output(jobs.output(spark, _analyzer(spark, sf_dir), "anomalies").read())


def q_stream_stats_docs(spark, sf_dir):
    """Stage-2 documents that the running analyzer commits."""
    return jobs.output(spark, _analyzer(spark, sf_dir, "stats"), "stats_docs").read()


def q_stream_index_docs(spark, sf_dir):
    """Stage-1 documents that the running analyzer commits."""
    return jobs.output(spark, _analyzer(spark, sf_dir, "alive"), "agg_docs").read()


# stand-in input with a server that stops: from this time on its sessions are served by another
FAILOVER_FROM, FAILOVER_TO = ("bras3", "10.0.0.3"), ("bras4", "10.0.0.4")
FAILOVER_TIME = "2024/01/16 00:00:00"


def failover_lines(lines_):
    """All lines; fields 11 and 12 of those that a server would have sent after it stopped name the other."""
    f = F.split(F.col("value"), ",", -1)
    moved = (F.substring_index("value", ",", 1) >= FAILOVER_TIME) & (F.get(f, 12) == FAILOVER_FROM[1])
    other = F.array_join(F.concat(F.slice(f, 1, 11), F.array(*map(F.lit, FAILOVER_TO)), F.slice(f, 14, 100)), ",")
    return lines_.select(F.when(moved, other).otherwise(F.col("value")).alias("value"))


def q_stream_alive_anomalies_filled(spark, sf_dir):
    """The live check with zero windows for silent servers; one stops mid-stream."""
    lines_ = failover_lines(jobs.event_line_stream(spark, sf_dir, 2))
    root = _analyzer(spark, sf_dir, "anomalies", lines=lines_, fill=True)
    return to_output(jobs.output(spark, root, "anomalies").read())


def q_alive_anomalies_filled(spark, sf_dir):
    """Anomalies with zero counts for silent windows."""
    counts, st = alive_and_stats(spark, sf_dir)
    return to_output(anomaly.alive_anomalies(fo.fill_silent_windows(counts, CFG.bras_agg1_seconds), st, CFG))


QUERIES: dict[str, Query] = {
    "parse_cdr": q_parse_cdr,
    "parse_cdr_full": q_parse_cdr_full,
    "cdr_tuple22": q_cdr_tuple22,
    "quarantine": q_quarantine,
    "access_node": q_access_node,
    "alive_count": q_alive_count,
    "stop_cause_count": q_stop_cause_count,
    "alive_count_filled": q_alive_count_filled,
    "first_order_3": q_first_order_3,
    "first_order_4": q_first_order_4,
    "agg_lines": q_agg_lines,
    "agg_line_roundtrip": q_agg_line_roundtrip,
    "second_order_values": q_second_order_values,
    "second_order_stats": q_second_order_stats,
    "second_order_exact": q_second_order_exact,
    "second_order_list_stats": q_second_order_list_stats,
    "latest_stats": q_latest_stats,
    "alive_anomalies": q_alive_anomalies,
    "index_docs_1": q_index_docs_1,
    "index_docs_2": q_index_docs_2,
    "cause_ratio": q_cause_ratio,
    "cause_ratio_batch": q_cause_ratio_batch,
    "cause_index": q_cause_index,
    "cause_mix": q_cause_mix,
    "cause_mix_batch": q_cause_mix_batch,
    "cause_mix_top30": q_cause_mix_top30,
    "centre_distance": q_centre_distance,
    "distance_summary": q_distance_summary,
    "sigma_outliers": q_sigma_outliers,
    "kmeans_distance": q_kmeans_distance,
    "kmeans_outliers": q_kmeans_outliers,
    "replay_rebase": q_replay_rebase,
    "replay_publish": q_replay_publish,
    "minute_files": q_minute_files,
    "stream_minute_files": q_stream_minute_files,
    "stream_alive_count": q_stream_alive_count,
    "distance_summary_merged": q_distance_summary_merged,
    "sigma_outliers_merged": q_sigma_outliers_merged,
    "cause_mix_stable": q_cause_mix_stable,
    "vector_sum": q_vector_sum,
    "sql_cdr_items": q_sql_cdr_items,
    "stream_sql_counts": q_stream_sql_counts,
    "stream_restart": q_stream_restart,
    "stream_late_rows": q_stream_late_rows,
    "stream_stop_cause": q_stream_stop_cause,
    "stream_second_order": q_stream_second_order,
    "stream_hop_second_order": q_stream_hop_second_order,
    "stream_bad_sessions": q_stream_bad_sessions,
    "stream_kmeans_outliers": q_stream_kmeans_outliers,
    "stream_kmeans_distance": q_stream_kmeans_distance,
    "stream_alive_anomalies": q_stream_alive_anomalies,
    "stream_alive_anomalies_filled": q_stream_alive_anomalies_filled,
    "stream_stats_docs": q_stream_stats_docs,
    "stream_index_docs": q_stream_index_docs,
    "stream_second_order_batches": q_stream_second_order_batches,
    "alive_anomalies_filled": q_alive_anomalies_filled,
    "replay_quarantine": q_replay_quarantine,
}

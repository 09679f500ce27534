"""Parsing goldens (FIXTURES G1) and the parsing traps."""

import datetime as dt

from pyspark.sql import functions as F

from acctlens.functions.scalars import safe_int, safe_long, valid_event_time
from acctlens.operators.ingest import cdr_tuple22, parse_agg_line, parse_cdr, parse_cdr_full, quarantine
from acctlens.schema import CDR22_NAMES, CDR24_NAMES, FIELD_NAMES_28, RADIUS_NAMES_28
from tests.conftest import lines_df

G1 = [
    "2019/12/04 00:00:05,1575417605,Alive,S1,120,1000,0,2000,0,10,20,bras01,10.0.0.1,7,C1,1,user1,NODE7 atm 0/1,,rem,100.64.0.1,conn,,0,0,0,,aa:bb",
    "2019/12/04 00:00:06,1575417606,Alive,S2,x,1000,0,2000,0,10,20,bras01,10.0.0.1,7,C2,2,user2,nospace,OLT3 xpon 0/2,rem,100.64.0.2,conn,,0,0,0,,aa:bc",
    "2019/12/04 00:00:07,1575417607,Stop,S3, 5 ,5.7,0,2000,0,10,20,bras02,10.0.0.2,7,C3,2,user3,,,rem,100.64.0.3,conn,User-Request,0,0,0,,aa:bd",
    "2019/12/04 00:00:08,1575417608,Stop,S4,9,1,0,2,0,1,2,bras02,10.0.0.2,7,C4,2,user4,,,rem,100.64.0.4,conn,Lost-Carrier,0,0,0,,",
    "2019/12/04 00:00:09,1575417609,Alive,S5",
    "2019-12-04,1575417610,Alive,S6,1,1,0,2,0,1,2,bras02,10.0.0.2,7,C6,2,user6,,,rem,100.64.0.6,conn,,0,0,0,,aa:be",
]


def test_g1_parse(spark):
    rows = {r.acctSessionId: r for r in parse_cdr(lines_df(spark, G1)).collect()}
    assert sorted(rows) == ["S1", "S2", "S3", "S4"]
    expect = {
        "S1": ("NODE7 atm", 120, 1000, "", " 00:00:05"),
        "S2": ("OLT3", 0, 1000, "", " 00:00:06"),
        "S3": ("<NONE>", 0, 0, "User-Request", " 00:00:07"),
        "S4": ("<NONE>", 9, 1, "Lost-Carrier", " 00:00:08"),
    }
    for sid, (node, st, oo, cause, day) in expect.items():
        r = rows[sid]
        assert (r.accessNode, r.sessionTime, r.outputOctets, r.terminateCause, r.day) == (node, st, oo, cause, day)
    assert rows["S4"].mac == ""
    assert rows["S1"].date == dt.datetime(2019, 12, 4, 0, 0, 5)


def test_g1_quarantine(spark):
    q = {r.value: r.reason for r in quarantine(lines_df(spark, G1)).collect()}
    assert q == {G1[4]: "too_few_fields", G1[5]: "bad_date"}


def test_strict_drops_trailing_empty_field(spark):
    strict = parse_cdr(lines_df(spark, G1), strict=True)
    assert sorted(r.acctSessionId for r in strict.collect()) == ["S1", "S2", "S3"]
    q = quarantine(lines_df(spark, G1), strict=True).filter(F.col("value").startswith("2019/12/04 00:00:08"))
    assert q.first().reason == "too_few_fields"


def test_layouts(spark):
    df = lines_df(spark, G1)
    assert parse_cdr(df).columns == CDR24_NAMES
    assert cdr_tuple22(df).columns == CDR22_NAMES
    full = parse_cdr_full(df)
    assert full.columns == FIELD_NAMES_28
    assert dict(full.dtypes)["accessType"] == "int"
    assert parse_cdr_full(df, radius_names=True).columns == RADIUS_NAMES_28


def test_safe_numbers(spark):
    vals = [" 5 ", "5.7", "+5", "-7", "", "x", "99999999999999999999", "0042"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [(r.l, r.i) for r in df.select(safe_long("s").alias("l"), safe_int("s").alias("i")).collect()]
    assert got == [(0, 0), (0, 0), (5, 5), (-7, -7), (0, 0), (0, 0), (0, 0), (42, 42)]
    # 2147483648 fits a long but not an int
    r = spark.createDataFrame([("2147483648",)], "s string").select(safe_long("s"), safe_int("s")).first()
    assert tuple(r) == (2147483648, 0)


def test_event_time_guard(spark):
    vals = ["2019/12/4 0:0:5", "2019-12-04 00:00:05.123", "2019-12-04", "2019/13/04 00:00:00", "garbage"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r.ok for r in df.select(valid_event_time("s").alias("ok")).collect()] == [True, True, False, False, False]


def test_agg_line_parse(spark):
    df = lines_df(spark, ["agg1_cdr_alive_bras,2024-01-01 06:00:00.0,10.0.0.1,17",
                          "agg1_cdr_alive_bras,2024-01-01 06:00:00.0,10.0.0.2,bad"])
    rows = parse_agg_line(df, 1).orderBy("aggField1").collect()
    assert [(r.aggField1, r.value) for r in rows] == [("10.0.0.1", 17), ("10.0.0.2", 0)]
    assert rows[0].timestamp == dt.datetime(2024, 1, 1, 6, 0)
    two = parse_agg_line(lines_df(spark, ["n,2024-01-01 06:00:00.0,a,b,3"]), 2).first()
    assert (two.aggField1, two.aggField2, two.value) == ("a", "b", 3)

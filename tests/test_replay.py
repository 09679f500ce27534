"""Replay re-basing (G7), minute files (G8) and message keys (G9)."""

import datetime as dt
import os
import tempfile

from acctlens.operators.replay import publish_records, rebase_lines
from acctlens.sources.minute_files import minute_file_lines
from tests.conftest import lines_df
from tests.test_ingest import G1


def test_g7_rebase(spark):
    line = "2019/12/04 00:10:00" + G1[0][19:]
    out = rebase_lines(lines_df(spark, [line]), dt.datetime(2019, 12, 4), dt.datetime(2026, 1, 1), 10).first()
    assert out.releaseTime == dt.datetime(2026, 1, 1, 0, 1, 0)
    assert out.value.startswith("2026/01/01 00:01:00,")
    assert out.value.split(",")[1:] == line.split(",")[1:]
    same = rebase_lines(lines_df(spark, [line]), dt.datetime(2019, 12, 4), dt.datetime(2026, 1, 1), 10,
                        change_date=False).first()
    assert same.value == line


def test_g9_key(spark):
    rec = publish_records(rebase_lines(lines_df(spark, G1[:1]), dt.datetime(2019, 12, 4), dt.datetime(2026, 1, 1)))
    assert rec.first().key == "10.0.0.1-S1-120"


def test_strict_replay_shortens_lines(spark):
    rec = rebase_lines(lines_df(spark, [G1[3]]), dt.datetime(2019, 12, 4), dt.datetime(2026, 1, 1),
                       change_date=False, strict=True).first()
    assert rec.value == G1[3].rstrip(",")


def _write(root, leaf, minutes):
    os.makedirs(f"{root}/{leaf}", exist_ok=True)
    for m in minutes:
        with open(f"{root}/{leaf}/cdr.2019-12-04T00-{m:02d}.txt", "w") as fh:
            fh.write(f"2019/12/04 00:{m:02d}:05,x,Alive\n")


def test_g8_minute_files(spark):
    root = tempfile.mkdtemp(prefix="acctlens-minutes-")
    _write(root, "leafA", [0, 1, 23])   # 21 missing -> stop before 23
    _write(root, "leafB", [0, 1, 22])   # 20 missing -> keep all
    _write(root, "leafC", [25])         # 25 missing before the first file -> nothing
    got = minute_file_lines(spark, root, "2019-12-04T00-00", layout="reference").collect()
    by_leaf = {}
    for r in got:
        by_leaf.setdefault(r.leaf, []).append(r.minute.minute)
    assert sorted(by_leaf["leafA"]) == [0, 1]
    assert sorted(by_leaf["leafB"]) == [0, 1, 22]
    assert "leafC" not in by_leaf
    later = minute_file_lines(spark, root, "2019-12-04T00-01", layout="reference").collect()
    assert sorted(r.minute.minute for r in later if r.leaf == "leafB") == [1, 22]

import random

from pyspark.sql import functions as F

from acctlens.llm.queries import URL_RULES
from acctlens.llm.url_rules import apply_rules


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


def check(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, key string, shard string")
    df = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(tuple(r) for r in apply_rules(pages, df, **options).collect())
    assert got == [(i, *brute(u, rules, **options)) for i, u in enumerate(urls)]


def test_edge_cases(spark):
    check(spark, [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/x?q#f", "http://a.example.org/en/1?x", "http://example.org",
                  "http://notexample.org/es/", "x://y.com/de/", "x://com/fr/", "x://org?/a", "x://org/#", "http://a.org.com/de", "a://b://c.org/",
                  "http://É.example.org/es/" + "y" * 20000, "http://example.org./es/", "http://example.org:80/es/"] + ["http://a.org/"] * 40,
          URL_RULES)
    check(spark, [], URL_RULES)
    check(spark, ["http://a.b/c"], [("b", "/c", "allow"), ("b", "/c", "block")], default="block")


def test_random_nested_rules_over_shards(spark, monkeypatch):
    import acctlens.llm.url_rules as m
    monkeypatch.setattr(m, "ROWS_PER_SHARD", 40)
    r = random.Random(1)
    label = lambda: r.choice(["a", "b", "c-d", "e1", "f"])
    host = lambda n: ".".join(label() for _ in range(r.randrange(1, n)))
    path = lambda: "/" + "/".join(label() for _ in range(r.randrange(3)))
    rules = [(host(4), path(), r.choice(["allow", "block"])) for _ in range(60)]
    check(spark, [f"http://{host(6)}{path()}" for _ in range(900)] + ["http://a.a/"] * 200, rules)


def test_each_shard_is_a_task_and_null_ids_stay(spark, monkeypatch):
    import acctlens.llm.url_rules as m
    monkeypatch.setattr(m, "ROWS_PER_SHARD", 40)
    urls = [f"http://h{i}.org/es/{i}" for i in range(500)] + ["http://hot.example.org/es/x"] * 500
    pages = spark.createDataFrame([(i if i % 7 else None, u) for i, u in enumerate(urls)], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    got = apply_rules(pages, rules).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.rule, r.verdict) for r in got) == sorted(
        (i % 7 == 0, i if i % 7 else 0, *brute(u, URL_RULES)[2:]) for i, u in enumerate(urls))
    load = {}
    for r in got:
        load[r.task] = load.get(r.task, 0) + 1
    assert len(load) >= 23 and max(load.values()) < 150  # 25 shards

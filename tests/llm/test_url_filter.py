"""URL filter against its SQL, plain Python and small tables."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from scrubline.llm import url_filter as uf
from scrubline.llm.queries import ORACLE_SQL, QUERIES
from scrubline.llm.url_filter import Bloom, Rule


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_equals_sql(spark, scale):
    sf = f"/root/testdata/{scale}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    result = con.execute(ORACLE_SQL["op1_url_filter"])
    names = [c[0] for c in result.description]
    df = QUERIES["op1_url_filter"](spark, sf)
    assert Counter(tuple(r) for r in df.select(names).collect()) == Counter(result.fetchall())


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    at, rest = rest[:cut], rest[cut:]
    end = min([i for c in "?#" if (i := rest.find(c)) >= 0], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in at), rest[:end]


URLS = [
    (1, "http://a.com/x"), (2, "https://EXAMPLE.com/en/1?q=1#top"), (3, "http://www.example.com/en/9"), (4, "http://m.www.example.com/en/"),
    (5, "http://b.net/es/"), (6, "http://net/fr/1"), (7, "http://notnet/fr/1"), (8, "http://x.net"), (9, None), (10, ""), (11, "no scheme.com/x"),
    (12, "http://com"), (13, "http://É.com/a\nb"), (14, "http://listed.org/p/?utm_source=a&b=1"), (15, "ftp://www.listed.org/p?b=1#z"), (16, "http://listed.org/q"),
    (17, "http://a?b://c.com/"), (18, "http://"), (19, "http://x.example.com/EN/1"), (14, "http://listed.org/p/?utm_source=a&b=1"),
    (20, "http://listed.org/r?ref=1&refx=2"), (None, "http://net/es/"),
]


def test_edges(spark):
    pages = spark.createDataFrame([(*u, "mine") for u in URLS], "page_id bigint, url string, verdict string").withColumn("w0", F.lit(1))
    listed = spark.createDataFrame([("listed.org/p?b=1",), ("listed.org/p?b=1",), (None,), ("listed.org/r?refx=2",), ("a.com/x",)], "url string")
    rows = uf.judge(pages, listed).collect()
    assert Counter((r.page_id, r.host, r.path) for r in rows) == Counter((i, *plain(u)) for i, u in URLS)
    rule = {r.page_id: r.rule for r in rows}
    assert rule[1] == "com/" and rule[2] == "example.com/en/" and rule[3] == rule[4] == "www.example.com/en/" and rule[5] == "net/es/"
    assert rule[6] == "net/fr/" and rule[7] is rule[8] is rule[9] is rule[12] is None and rule[19] == "com/" and rule[None] == "net/es/"
    verdict = {r.page_id: r.verdict for r in rows}
    assert [i for i, v in verdict.items() if v == "block" and rule[i] is None] and {i for i, v in verdict.items() if v == "block"} == {2, 5, 6, 14, 15, 20, None}
    assert verdict[1] == "allow"
    assert uf.judge(pages.limit(0), listed).collect() == []
    assert {r.verdict for r in uf.judge(pages, listed.limit(0), ()).collect()} == {"allow"}


def test_false_positives_are_removed(spark):
    """A filter of one bit per URL lets nearly everything through; the verdicts stay exact. One URL holds most rows."""
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.when(F.col("id") < 1500, "http://hot.org/a").otherwise(F.concat(F.lit("http://x.org/"), "id")).alias("url"))
    listed = pages.filter("page_id % 3 = 0").select(uf.canonical(F.col("url")).alias("url"))
    known = {r.url for r in listed.collect()}
    for size in (Bloom(), Bloom(bits_per_url=1, sent_blocks=1)):
        rows = uf.judge(pages, listed, (), size).collect()
        assert len(rows) == 3000
        assert all((r.verdict == "block") == (r.url[7:] in known) for r in rows)


def test_filter_passes_few_others(spark):
    urls = spark.range(20_000).select(F.concat(F.lit("http://x.org/"), "id").alias("url"))
    listed = urls.filter("crc32(url) % 4 = 0").select(uf.canonical(F.col("url")).alias("url"))
    blocks, n = uf.bloom(listed, Bloom())
    assert n > 100 and blocks.count() <= n
    bad = "array(" + ",".join(f"w{i}" for i in range(8)) + ")"
    probe = urls.select(uf.canonical(F.col("url")).alias("url")).join(listed, "url", "left_anti")
    probe = probe.select(uf._block(F.col("url"), n).alias("block"), F.array(*uf._masks(F.col("url"))).alias("m")).join(blocks, "block")
    passed = probe.filter(f"forall(zip_with(m, {bad}, (x, y) -> (x & y) = x), z -> z)").count()
    assert passed < 0.01 * 15_000


def test_rules_may_be_given(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/d/e"), (2, "http://b.c/d"), (3, "http://c/")], "page_id bigint, url string")
    rules = (Rule("block", "c", "/"), Rule("allow", "b.c", "/d"), Rule("block", "b.c", "/d/"))
    rows = {r.page_id: (r.rule, r.verdict) for r in uf.judge(pages, pages.select("url").limit(0), rules).collect()}
    assert rows == {1: ("b.c/d/", "block"), 2: ("b.c/d", "allow"), 3: ("c/", "block")}


def test_empty_tables_and_very_long_urls(spark):
    page = "page_id bigint, url string, html string"
    empty = spark.createDataFrame([], page)
    assert uf.judge(empty, uf.junk_urls(empty)).collect() == []
    long = "http://host.org/" + "p" * 2_000_000
    rows = spark.createDataFrame([(1, long, "!!"), (2, long + "q", "")], page)
    assert uf.judge(rows, uf.junk_urls(empty)).filter("verdict = 'block'").collect() == []
    judged = {r.page_id: (r.host, len(r.path), r.verdict) for r in uf.judge(rows, uf.junk_urls(rows)).collect()}
    assert judged == {1: ("host.org", 2_000_001, "block"), 2: ("host.org", 2_000_002, "allow")}


def test_large_filters_stay_sharded(spark):
    """Blocks grow with the list; over the limit pages meet them by a shuffle, with the same verdicts."""
    urls = [(i, f"http://site{i % 50}.org/{i}") for i in range(6000)] + [(i, "http://hot.org/a") for i in range(2000)] + URLS
    pages = spark.createDataFrame(urls, "page_id bigint, url string").withColumn("block", F.lit("mine"))
    listed = pages.filter("crc32(url) % 5 = 0 or url like '%hot%' or url like '%example%'").select(uf.canonical(F.col("url")).alias("url"))
    _, blocks = uf.bloom(listed.filter("url is not null").distinct(), Bloom())
    assert blocks > 16
    names = ["page_id", "url", "block", "host", "path", "rule", "verdict"]
    rows = [Counter(tuple(r) for r in uf.judge(pages, listed, size=size).select(names).collect()) for size in (Bloom(), Bloom(sent_blocks=16))]
    assert rows[0] == rows[1] and sum(rows[0].values()) == len(urls)
    assert sum(n for r, n in rows[0].items() if r[1] == "http://hot.org/a" and r[6] == "block") == 2000
    plan = lambda size: uf.judge(pages, listed, size=size)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan(Bloom(sent_blocks=16)) and "strategy=broadcast" in plan(Bloom())

from pyspark.sql import functions as F

from landloom.llm import urls

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]


def test_rules_and_list(spark):
    rows = [("http://a.example.com/en/x?q", "block"), ("http://WWW.Example.com/en/x", "allow"), ("http://example.com", "allow"), ("http://notexample.com/en/", "allow"),
            ("https://x.net/es/1", "block"), ("https://x.net/de/1", "block"), ("https://www.x.net/de/1/#top", "block"), ("https://x.net/de/11", "allow"),
            ("https://u.org:80/a//", "block"), (None, "allow"), ("", "allow"), ("no address", "allow"), ("a://b://c/en", "allow"), ("http:///path", "allow")]
    pages = spark.createDataFrame([(i, u, "h") for i, (u, _) in enumerate(rows)] + [(0, rows[0][0], "again")], "page_id long, url string, address string")
    listed = spark.createDataFrame([("http://x.net/de/1",), ("http://x.net/de/1",), ("ftp://u.org/a",), (None,), ("",)], "url string")
    got = urls.judge_urls(pages, RULES, listed).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        assert r["verdict"] == rows[r["page_id"]][1], r
    by = {r["page_id"]: r for r in got}
    assert by[0]["rule"] == "example.com/en/" and by[1]["rule"] == "www.example.com/en/" and by[2]["rule"] is None and by[12]["host"] == "b:"
    assert {r["verdict"] for r in urls.judge_urls(pages.filter("page_id in (5, 9)"), RULES, listed.limit(0)).collect()} == {"allow"}
    assert urls.judge_urls(pages.limit(0), RULES, listed).count() == 0


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(2000).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("address"))
    other = spark.range(20000).select(F.concat(F.lit("o/"), F.col("id").cast("string")).alias("address"))
    blocks = 2000 // urls.PER_BLOCK
    table = urls.bloom_filter(listed, blocks)

    def passed(df):
        hit = " and ".join(f"(w{k} & b{k}) = b{k}" for k in range(urls.WORDS))
        return df.select(*urls._places(F.col("address"), blocks)).join(table, "block").filter(hit).count()
    assert passed(listed) == 2000
    assert passed(other) < 600
    assert urls.listed_pages(other.union(listed), listed).count() == 2000


def test_large_filters_are_joined_by_block(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_BLOCKS", 0)
    test_rules_and_list(spark)

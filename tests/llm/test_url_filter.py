import duckdb

from haulback.llm import queries
from haulback.llm.url_filter import judge_urls

URLS = [
    "http://a.example.org/en/2?q=casino",
    "http://Example.ORG/es/3",
    "https://x.example.org/en/17#top",
    "https://notexample.com/fr/free-bets",
    "https://free-bets.com/en/9",
    "http://freebets.com/en/9",
    "http://poker.example.net",
    "http://a.com/de/1/casino",
    "no scheme casino",
    "http://org",
    "http://a.net/?u=http://b.org/x",
    "",
    None,
    "http://cheap.example.net/" + "x/" * 20_000 + "pills",
    "http://x.net/écasino",
    "http://x.net/casinoÉ/٣poker/slotsЖ",
    "http://x.net/—casino—",
]


def test_rules_terms_and_odd_rows_as_sql(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(None, URLS[0], "x"), (0, URLS[0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, n_soft string")
    got = judge_urls(pages, queries.URL_RULES).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    expected = con.sql(queries.SQL["op5_url_filters"]).fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    verdicts = {r.page_id: r.verdict for r in got}
    blocked = [1, 2, 4, 6, 7, 8, 13, 16]
    assert [verdicts[i] for i in range(len(URLS))] == [
        "block" if i in blocked else "allow" for i in range(len(URLS))
    ]
    assert {r.page_id: r.rule for r in got}[2] == "example.org/en/1"


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, queries.URL_RULES).count() == 0

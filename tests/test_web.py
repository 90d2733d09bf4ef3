import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from moorage.functions import urls
from moorage.operators import discovery, history
from moorage.sources import html


# Pieces of pages and the links in each.
PIECES = {
    '<a href="/x.csv">': ["/x.csv"],
    "<a href='/y z.csv' >": ["/y z.csv"],
    "<A HREF=/w.csv>": ["/w.csv"],
    "<a class='b' href=\"/q?a=1&amp;b=2\" id=c>": ["/q?a=1&b=2"],
    "<a href>": [],
    '<a href="">': [],
    "<!-- <a href='/no'> -->": [],
    "<script>var s = '<a href=\"/no\">';</script>": [],
    "<style>a{} <a href='/no'></style>": [],
    "<abbr href='/no'>": [],
    '<a data-href="/no" href="/yes">': ["/yes"],
    "<a title='> href=/no' href='/ok'>": ["/ok"],
    '<a\n  href = "/line"\n>': ["/line"],
    "<a href='/caf&eacute;'>": ["/café"],
    "<a href='/n&#49;'/>": ["/n1"],
    '<a href="a" href="b">': ["a", "b"],
    "text </a>": [],
    "<p>": [],
    '<a name="top">': [],
    "<a href=\"x'y\">": ["x'y"],
}


def test_links_of_pieces_and_pages(spark):
    rng = random.Random(7)
    docs = [[piece] for piece in PIECES] + [rng.choices(list(PIECES), k=6) for _ in range(60)]
    df = spark.createDataFrame([(i, "".join(d)) for i, d in enumerate(docs)], "id int, html string")
    got = {i: [] for i in range(len(docs))}
    for r in html.links(df, ["id"]).orderBy("id", "pos").collect():
        got[r.id].append(r.href)
    for i, doc in enumerate(docs):
        assert got[i] == [link for piece in doc for link in PIECES[piece]], doc


def test_resolve_like_urljoin(spark):
    bases = [
        "https://h.example.org/a/b/page", "http://h.example.org", "http://h.example.org/", "http://h.example.org/a/?q=1/2#f/g",
        "https://h.example.org/a/../b/", "HTTP://H.example.org/a/b", "http://h.example.org/a;p=1/b",
    ]
    links = [
        "/x.csv", "x.csv", "d/x.csv", "../x.csv", "./x.csv", "//o.example.org/x", "https://o.example.org/x?y=1", "?q=2", "#top", "x.csv#p", "x.csv?q=/a/b",
        "mailto:a@b.c", "http:x.csv", "", "/", "a//b", "x;y", "/a/./b", "2024 taxroll.xlsx", "javascript:void(0)", "/x.csv?", "..", ".",
    ]
    pairs = [(b, u) for b in bases for u in links]
    df = spark.createDataFrame(pairs, "b string, u string")
    for r in df.select("b", "u", urls.resolve(F.col("b"), F.col("u")).alias("r")).collect():
        assert r.r == urljoin(r.b, r.u), (r.b, r.u)


def test_template_regex_is_literal_but_for_placeholders(spark):
    df = spark.createDataFrame([("/f/2024taxroll.xlsx",), ("/f/2024TAXROLL.XLSX?v=1",), ("/f/2024taxrollAxlsx",), ("/f/24taxroll.xlsx",)], "u string")
    hit = df.select(F.col("u").rlike(urls.template_regex("{year}taxroll.xlsx")).alias("h")).collect()
    assert [r.h for r in hit] == [True, True, False, False]


TEMPLATES = ["{year}taxroll.xlsx", "TaxRoll{year}.xlsx"]
FIELDS = {"year": r"\d{4}"}


def test_discovery_index_first_then_probing(spark):
    index = spark.createDataFrame(
        [
            ("a", "https://h/a/", '<a href="2022taxroll.xlsx"></a><a href="/a/2023taxroll.xlsx"></a><a href="2023taxroll.xlsx"></a><a href="readme.txt"></a>'),
            ("b", "https://h/b/", "<p>nothing here</p>"),
        ],
        "name string, base_url string, html string",
    )
    datasets = index.select("name", "base_url")
    answered = [f"https://h/b/{n}" for n in ("2024taxroll.xlsx", "TaxRoll2024.xlsx", "TaxRoll2023.xlsx", "2019taxroll.xlsx", "2015taxroll.xlsx")]
    existing = spark.createDataFrame([(u,) for u in answered], "url string")
    rows = discovery.discover(index, datasets, existing, ["name"], TEMPLATES, FIELDS, start_year=2025).collect()
    assert [(r.name, r.url.rsplit("/", 1)[1], r.partition_values["year"]) for r in rows] == [
        ("b", "2024taxroll.xlsx", "2024"), ("a", "2023taxroll.xlsx", "2023"), ("b", "TaxRoll2023.xlsx", "2023"), ("a", "2022taxroll.xlsx", "2022"),
    ]


@pytest.mark.parametrize(
    "years, start, kept",
    [([2024, 2021, 2017], 2024, [2024, 2021]), ([2021], 2024, []), ([2022], 2024, [2022]), ([2010, 2011, 2013], 2013, [2013, 2011, 2010]), ([2009], 2010, [])],
)
def test_probing_stops_after_three_misses(spark, years, start, kept):
    datasets = spark.createDataFrame([("d", "https://h/")], "name string, base_url string")
    existing = spark.createDataFrame([(f"https://h/{y}taxroll.xlsx",) for y in years], "url string")
    tried = discovery.candidates(datasets, ["name"], TEMPLATES, start)
    got = discovery.probe_years(tried, existing, ["name"], start).orderBy(F.desc("year")).collect()
    assert [r.year for r in got] == kept


def test_manifest_keeps_files_without_partition(spark):
    files = spark.createDataFrame([("https://h/2024x.csv?v=1",), ("https://h/plain.csv",)], "url string")
    rows = discovery.manifest(files, [], FIELDS).orderBy("url").collect()
    assert [(r.filename, r.partition_values) for r in rows] == [("2024x.csv?v=1", {"year": "2024"}), ("plain.csv", {})]


def test_history_round_trip(spark, folder):
    assert history.read_history(spark, folder).count() == 0
    loaded = spark.createDataFrame(
        [("d", "j", "u1", "f1", {"year": "2024"}, 5, "h1"), ("e", "j", "u2", "f2", {}, 6, None)],
        "dataset_name string, jurisdiction string, url string, filename string, partition_values map<string,string>, row_count int, file_hash string",
    )
    history.append(history.records(loaded, "2025-01-01T00:00:00"), folder)
    history.append(history.records(loaded.where("url = 'u1'"), "2025-02-01T00:00:00"), folder)
    past = history.read_history(spark, folder)
    assert [r.loaded_at[:7] for r in history.newest_first(history.select_history(past, "j", "d")).collect()] == ["2025-02", "2025-01"]
    assert {r.source_url for r in history.loaded_urls(past).collect()} == {"u1", "u2"}
    assert past.where("source_url = 'u1'").first().partition_values == '{"year":"2024"}'
    found = spark.createDataFrame([("u1", "h9"), ("u3", "x"), ("u3", "x"), ("u2", None)], "url string, file_hash string")
    assert sorted(r.url for r in history.unloaded(found, past).collect()) == ["u3", "u3"]
    assert sorted(r.url for r in history.unloaded(found, past, match_hash=True).collect()) == ["u1", "u3", "u3"]
    assert history.unloaded(found, past, force=True).count() == 4

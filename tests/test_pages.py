"""Paging rules and response bodies."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import pages as G


def bodies(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "page_no int, body string")


def test_normalise(spark):
    df = bodies(spark, '[{"a":1}]', '{"a":1}', '{"results":[1]}', "5")
    got = G.normalise_responses(df).orderBy("page_no").select(F.to_json("page")).collect()
    assert [r[0] for r in got] == ['{"results":[{"a":1}]}', '{"results":[{"a":1}]}', '{"results":[{"results":[1]}]}', "5"]
    kept = G.normalise_responses(df, records_path=["x"]).orderBy("page_no").select(F.to_json("page")).collect()
    assert [r[0] for r in kept] == ['{"results":[{"a":1}]}', '{"a":1}', '{"results":[1]}', "5"]


def test_explode(spark):
    df = G.normalise_responses(bodies(spark, '{"d":{"items":[{"a":1},7,null,{"a":2}]}}'), records_path=["d", "items"])
    got = G.explode_records(df, ["d", "items"]).select("pos", F.to_json("rec")).collect()
    assert [tuple(r) for r in got] == [(0, '{"a":1}'), (3, '{"a":2}')]
    with pytest.raises(Exception, match="no records array at x.y"):
        G.explode_records(df, ["x", "y"]).collect()
    with pytest.raises(Exception):
        G.normalise_responses(bodies(spark, "not json")).collect()


@pytest.mark.parametrize(
    ("url", "paged"),
    [
        ("http://h/x", "http://h/x?page=2"),
        ("http://h/x?page=7&page=8", "http://h/x?page=2"),
        ("http://h/x?z=1&a=x+y&a=%41*~&bad=%zz&e#top", "http://h/x?a=x+y&a=A%2A~&e=&page=2&z=1#top"),
        ("http://h/?q=a%26b&q2=%C3%A9", "http://h/?page=2&q=a%26b&q2=%C3%A9"),
        ("http://h/x?", "http://h/x?page=2"),
        ("http://h/x?a=1;b=2&c=3", "http://h/x?c=3&page=2"),
    ],
)
def test_page_urls(spark, url, paged):
    df = spark.createDataFrame([("s", url, "page", 2, 3)], "stream string, url string, query_parameter string, query_value int, query_increment int")
    got = [r.url for r in G.page_urls(df, 3).orderBy("page_no").collect()]
    assert got == [url, paged, paged.replace("page=2", "page=5")]


def test_cut_pages(spark):
    df = spark.createDataFrame(
        [("a", 0, 2), ("a", 1, 0), ("a", 2, 3), ("b", 0, 1), ("b", 1, 1), ("c", 0, 0)], "stream string, page_no int, n_records int"
    )
    got = sorted((r.stream, r.page_no) for r in G.cut_pages(df).collect())
    assert got == [("a", 0), ("a", 1), ("b", 0), ("b", 1), ("c", 0)]
    first = sorted((r.stream, r.page_no) for r in G.cut_pages(df, paginated=False).collect())
    assert first == [("a", 0), ("b", 0), ("c", 0)]


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_chains_against_a_walk(spark, n):
    """Chains that end with null, "", a missing link, an unknown page, or in a cycle."""
    ends = [{"next": None}, {"next": ""}, {}, {"next": "nowhere"}, {"next": "u0"}, {"next": f"u{n - 1}"}]
    for i, end in enumerate(ends):
        after = {f"u{k}": {"next": f"u{k + 1}"} for k in range(n - 1)}
        after[f"u{n - 1}"] = end
        df = spark.createDataFrame([("s", u, json.dumps(b)) for u, b in after.items()], "stream string, url string, body string")
        if n == 40 and i not in (3, 4):
            continue
        root = f"u{n // 2}"
        want, url = [], root
        while url in after and url not in want:
            want.append(url)
            url = after[url].get("next")
        roots = spark.createDataFrame([("s", root), ("s", "absent")], "stream string, url string")
        got = G.follow_next(df, roots, ["next"]).orderBy("page_no").collect()
        assert [(r.root, r.page_no, r.url) for r in got] == [(root, k, u) for k, u in enumerate(want)]

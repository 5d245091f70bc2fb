"""Landed API responses: records out of bodies, page URLs, and paging rules as joins.

Pages are tables; nothing is fetched here. A response table has ``stream, url, page_no, body``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import get_path, get_raw
from tidemark.functions.values import ARRAY, MAP
from tidemark.session import scratch_uri

DEFAULT_RECORDS_PATH = ("results",)


def normalise_responses(
    df: DataFrame, body: str = "body", records_path: Sequence[str] | None = None
) -> DataFrame:
    """Replace a JSON text column by ``page``, a VARIANT object that holds a records array.

    A bare array becomes the results of an object; an object without a records path becomes its only
    result; an object with one stays. A body that is no JSON fails the job."""
    parsed = df.withColumn("_page", F.parse_json(body))
    page = F.col("_page")
    wrap = lambda items: F.to_variant_object(F.struct(items.alias("results")))
    items = page.try_cast(ARRAY)
    normal = F.when(items.isNotNull(), wrap(items))
    if records_path is None:
        normal = normal.when(page.try_cast(MAP).isNotNull(), wrap(F.array(page)))
    others = [c for c in df.columns if c != body]
    return parsed.select(*others, normal.otherwise(page).alias("page"))


def records_array(page: Column, records_path: Sequence[str] | None = None) -> Column:
    """The records array of a normalised page; NULL if there is none."""
    path = DEFAULT_RECORDS_PATH if records_path is None else records_path
    return get_raw(page, path).try_cast(ARRAY)


def count_records(df: DataFrame, records_path: Sequence[str] | None = None) -> DataFrame:
    """Add ``n_records``, the length of each page's records array."""
    return df.withColumn("n_records", F.size(records_array(F.col("page"), records_path)))


def explode_records(
    df: DataFrame, records_path: Sequence[str] | None = None, keep_others: bool = False
) -> DataFrame:
    """One row per object in each page's records array, with its ``pos``; other columns are kept.

    A page without an array at the path fails the job. Items that are no objects are skipped; with
    ``keep_others`` they stay, with their text as ``raw`` and a ``reason``, which are NULL for objects."""
    shown = ".".join(DEFAULT_RECORDS_PATH if records_path is None else records_path)
    items = records_array(F.col("page"), records_path)
    checked = F.coalesce(
        items, F.raise_error(F.lit(f"response holds no records array at {shown}")).cast(ARRAY)
    )
    others = [c for c in df.columns if c != "page"]
    rows = df.select(*others, F.posexplode(checked).alias("pos", "rec"))
    is_object = F.col("rec").try_cast(MAP).isNotNull()
    if not keep_others:
        return rows.filter(is_object)
    raw = F.when(~is_object, F.coalesce(F.to_json("rec"), F.lit("null")))
    return rows.select("*", raw.alias("raw"), F.when(~is_object, "is not an object").alias("reason"))


def _query_escape(text: Column) -> Column:
    """Form encoding that keeps letters, digits and -_.~ and writes a space as +."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def set_query_parameter(url: Column, name: Column, value: Column) -> Column:
    """The URL with one query parameter set, its query re-encoded with sorted names.

    Repeated values of other parameters keep their order; parts that do not decode are left out."""
    address = F.substring_index(url, "#", 1)
    fragment = F.substring(url, F.length(address) + 1, F.length(url))
    base = F.substring_index(address, "?", 1)
    query = F.substring(address, F.length(base) + 2, F.length(address))
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.contains(";"))
    pairs = F.transform(
        parts,
        lambda p, i: F.struct(
            F.try_url_decode(F.substring_index(p, "=", 1)).alias("name"),
            i.alias("at"),
            F.try_url_decode(
                F.substring(p, F.length(F.substring_index(p, "=", 1)) + 2, F.length(p))
            ).alias("value"),
        ),
    )
    others = F.filter(
        pairs, lambda p: p["name"].isNotNull() & p["value"].isNotNull() & (p["name"] != name)
    )
    new = F.struct(name.alias("name"), F.lit(0).alias("at"), value.cast("string").alias("value"))
    encoded = F.transform(
        F.array_sort(F.concat(others, F.array(new))),
        lambda p: F.concat(_query_escape(p["name"]), F.lit("="), _query_escape(p["value"])),
    )
    return F.concat(base, F.lit("?"), F.array_join(encoded, "&"), fragment)


def page_urls(streams: DataFrame, n_pages: int | Column) -> DataFrame:
    """(stream, page_no, url) of query paging, for rows of ``stream, url, query_parameter,
    query_value, query_increment``. Page 0 is the URL as given; a stream of no pages has no row."""
    last = (F.lit(n_pages) if isinstance(n_pages, int) else n_pages) - 1
    pages = streams.withColumn("page_no", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last.cast("int")))))
    value = F.col("query_value") + (F.col("page_no") - 1) * F.col("query_increment")
    paged = set_query_parameter(F.col("url"), F.col("query_parameter"), value)
    return pages.select(
        "stream", "page_no", F.when(F.col("page_no") == 0, F.col("url")).otherwise(paged).alias("url")
    )


def cut_pages(
    pages: DataFrame, stream: str = "stream", page_no: str = "page_no",
    n_records: str = "n_records", paginated: bool = True,
) -> DataFrame:
    """Pages up to and including each stream's first empty one; only the first if not paginated.

    The end of each stream is a partial aggregation over two columns, joined back to the pages. A
    window over a stream would bring all of its pages to one task."""
    if paginated:
        end = F.min(F.when(F.col(n_records) == 0, F.col(page_no)))
    else:
        end = F.min(page_no)
    ends = pages.groupBy(F.col(stream).alias("_stream")).agg(end.alias("_end"))
    return (
        pages.join(ends, F.col(stream).eqNullSafe(F.col("_stream")), "left")
        .filter(F.col("_end").isNull() | (F.col(page_no) <= F.col("_end")))
        .drop("_stream", "_end")
    )


def next_url(body: Column, next_path: Sequence[str]) -> Column:
    """The link to the next page in a raw body; NULL where paging stops."""
    link = get_path(F.try_parse_json(body), next_path).try_cast("string")
    return F.when(link != "", link)


def _cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: rounds do not build on one plan, and a
    lost executor costs no recomputation of earlier rounds."""
    uri = scratch_uri(df.sparkSession, name)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def follow_next(pages: DataFrame, roots: DataFrame, next_path: Sequence[str]) -> DataFrame:
    """(stream, root, page_no, url) of next-link paging from each root URL over landed pages.

    Pointer doubling: round k joins what is reached with links that span 2^k pages, so a chain of n
    pages takes log2(n) rounds. Each page counts once per root, at its first place, so a cycle ends.
    ``pages`` has ``stream, url, body``; ``roots`` has ``stream, url``."""
    links = (
        pages.select("stream", "url", next_url(F.col("body"), next_path).alias("next"))
        .groupBy("stream", "url")
        .agg(F.min("next").alias("next"))
    )
    links = _cut_lineage(links, "links")
    landed = links.select("stream", "url")
    reached = (
        roots.select("stream", "url").distinct().join(landed, ["stream", "url"], "left_semi")
        .select("stream", F.col("url").alias("root"), F.col("url"), F.lit(0).cast("bigint").alias("page_no"))
    )
    # A link to a page that was not landed ends the chain.
    jump = links.filter("next IS NOT NULL").join(
        landed.withColumnRenamed("url", "next"), ["stream", "next"], "left_semi"
    ).select("stream", "url", "next")
    reached, jump = _cut_lineage(reached, "reached"), _cut_lineage(jump, "jump")
    n_reached, span = reached.count(), 1
    while True:
        further = reached.join(jump, ["stream", "url"]).select(
            "stream", "root", F.col("next").alias("url"), (F.col("page_no") + span).alias("page_no")
        )
        grown = (
            reached.unionByName(further)
            .groupBy("stream", "root", "url")
            .agg(F.min("page_no").alias("page_no"))
        )
        grown = _cut_lineage(grown, "reached")
        n_grown = grown.count()
        if n_grown == n_reached:
            return grown.select("stream", "root", "page_no", "url")
        second = jump.select("stream", F.col("url").alias("next"), F.col("next").alias("after"))
        jump = _cut_lineage(
            jump.join(second, ["stream", "next"]).select("stream", "url", F.col("after").alias("next")),
            "jump",
        )
        reached, n_reached, span = grown, n_grown, span * 2

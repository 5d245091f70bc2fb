"""Whole runs over one stream: discover, extract, refresh.

A run takes any DataFrame with a ``rec`` column, VARIANT or struct, and keeps its state in a Store.
Outcomes are written once and read back column by column, so that messages, bookmark and metrics
agree with each other although they are separate jobs, and a lost executor repeats no source read."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.config import StreamConfig
from tidemark.functions import keys as K
from tidemark.functions.values import is_variant
from tidemark.operators import bookmark as B
from tidemark.operators import discover as D
from tidemark.operators import messages as M
from tidemark.operators import metrics as X
from tidemark.operators import outcomes as O
from tidemark.operators import pages as G
from tidemark.operators.catalog import load_schema
from tidemark.operators.transform import now_text, transform, transform_all
from tidemark.session import check_settings
from tidemark.sources import files
from tidemark.sources.bookmark_log import BookmarkLog
from tidemark.sources.store import Store, StreamStore

OUTCOMES_SCHEMA = (
    "stream string, ord bigint, key string, nk_json string, _sdc_surrogate_key string, "
    "_sdc_timestamp string, _sdc_unique_key string, text string, reason string, outcome string"
)

# Messages repeat names and hold hashes as digits, and are most of what a run writes.
MESSAGE_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def read_source(spark: SparkSession, cfg: StreamConfig, pages: DataFrame | None = None) -> DataFrame:
    """Records of a source named by its configuration; ``pages`` holds the landed responses of an API.

    Lines that give no record stay, with a ``reason``, for the rejects of a run."""
    if cfg.source_type == "csv":
        kept = "keep" if cfg.on_bad == "quarantine" else "fail"
        return files.read_csv(spark, cfg.url, on_bad=kept, multi_line=cfg.multi_line)
    if cfg.source_type == "jsonl":
        return files.read_jsonl(spark, cfg.url, on_bad="fail" if cfg.on_bad == "fail" else "keep")
    if pages is None:
        raise ValueError("a rest stream is read from landed pages")
    return read_pages(cfg, pages)


def read_pages(cfg: StreamConfig, pages: DataFrame) -> DataFrame:
    """(ord, rec) of an API stream from its landed responses, a table of ``url`` and ``body``.

    Pages count as far as the stream's paging reaches them: the configured URL alone, what its next
    links lead to, or the URLs of its query parameter up to the first page without records or that
    was not landed. A URL that was landed twice counts once, as it was landed last if the table has a column
    ``landed_at``. Items that are no objects stay, with a ``reason``, for the rejects of a run."""
    spark, name = pages.sparkSession, F.lit(cfg.stream_name)
    body = F.max_by("body", "landed_at") if "landed_at" in pages.columns else F.min("body")
    landed = pages.groupBy("url").agg(body.alias("body")).withColumn("stream", name)
    if landed.filter(F.col("url") == cfg.url).isEmpty():
        raise ValueError(f"no response of {cfg.url} was landed")
    root = spark.createDataFrame(
        [(cfg.stream_name, cfg.url, cfg.query_parameter, cfg.query_value, cfg.query_increment)],
        "stream string, url string, query_parameter string, query_value bigint, query_increment bigint",
    )
    if not cfg.pagination:
        places = root.select("url", F.lit(0).cast("bigint").alias("page_no"))
    elif cfg.pagination_strategy == "next":
        places = G.follow_next(landed, root.select("stream", "url"), cfg.pagination_next_path)
        places = places.select("url", "page_no")
    else:
        places = G.page_urls(root, landed.count()).select("url", F.col("page_no").cast("bigint").alias("page_no"))
    placed = landed.join(places, "url")
    opened = G.normalise_responses(placed.select("stream", "page_no", "body"), records_path=cfg.records_path)
    if cfg.pagination and cfg.pagination_strategy == "query":
        # One row a page: the first number whose page is missing ends the stream as an empty page does.
        missing = places.join(landed.select("url"), "url", "left_anti").agg(F.min("page_no")).first()[0]
        opened = G.cut_pages(G.count_records(opened, cfg.records_path)).drop("n_records")
        if missing is not None:
            opened = opened.filter(F.col("page_no") < missing)
    return G.explode_records(opened, cfg.records_path, keep_others=True).select(
        (F.shiftleft("page_no", 32) + F.col("pos")).alias("ord"), "rec", "raw", "reason"
    )


@dataclass(frozen=True)
class RunResult:
    version: int
    messages: str
    rejects: str
    metrics: dict


def run_discover(
    source: DataFrame, cfg: StreamConfig, store: Store, discovered_at: str | None = None,
    needs_records: bool = True,
) -> dict | None:
    """Infer the stream's schema, merge it into the catalog, and return the JSON Schema.

    A source without a usable record leaves the catalog as it is. It raises where the catalog has
    nothing on the stream either, unless ``needs_records`` is false, as for a micro-batch.

    Records nested deeper than the first look reads are read again with more levels. The bookmark is
    left as it is. Lines that give no record are written as rejects, and the version's facts name the table
    (``rejects``) and their number (``rejected``); lines are looked at again only where there are any."""
    spark = source.sparkSession
    discovered_at = discovered_at or now_text()
    store = store.of(cfg.stream_name)
    table = store.catalog
    version = table.version() + 1
    existing = table.read(version - 1)
    output = store.output(version)
    readable, unread = _watched(source, cfg)
    depth, records = D.DEPTH, transform(readable, cfg, discovered_at)
    while True:
        found = D.found_types(records, cfg.unique_key_path, depth)
        uri = f"{output}/found-{depth}"
        found.write.parquet(uri)
        found = spark.read.schema(found.schema).parquet(uri)
        if found.filter("deeper").isEmpty():
            break
        depth *= 2
    facts, nothing = {}, found.isEmpty()
    # A plan that gave no row may have been cut short, and then has no counts.
    if unread is not None and (nothing or unread.get["n"]):
        uri = f"{output}/rejects"
        O.line_rejects(source, cfg.stream_name, _hides(cfg)).write.parquet(uri)
        if n := spark.read.parquet(uri).count():
            facts = {"rejects": uri, "rejected": n}
    if nothing:
        known = load_schema(existing, cfg.stream_name)
        if known is None and needs_records:
            said = f"; {facts['rejected']} lines gave no record, see {facts['rejects']}" if facts else ""
            raise ValueError(f"discovery of stream {cfg.stream_name} found no properties{said}")
        if not facts:
            return known
        path = table.write(existing, version)
    else:
        path = table.write(D.merge_found(found, existing, discovered_at), version)
    schema = load_schema(spark.read.schema(table.schema).parquet(path), cfg.stream_name)
    if schema is not None:
        facts["schema_message"] = f"{output}/schema"
        found = M.schema_messages(spark.read.schema(table.schema).parquet(path))
        found.select("message").write.text(facts["schema_message"])
    table.commit(version, path, schema_discovered_at=discovered_at, outputs=[output], **facts)
    return schema


def run_discover_many(
    sources: Sequence[tuple[DataFrame, StreamConfig]], store: Store, discovered_at: str | None = None,
    needs_records: bool = True,
) -> dict[str, dict | None]:
    """run_discover over several streams side by side, up to four at a time. Streams are named once; the first
    error of any is raised, and leaves the catalogs of the others as their own discovery does."""
    names = [cfg.stream_name for _, cfg in sources]
    if len(set(names)) < len(names):
        raise ValueError(f"a stream is named twice: {sorted(names)}")
    discovered_at = discovered_at or now_text()
    with ThreadPoolExecutor(max_workers=4) as pool:
        found = pool.map(lambda s: run_discover(s[0], s[1], store, discovered_at, needs_records), sources)
        return dict(zip(names, found))


def _watched(source: DataFrame, cfg: StreamConfig) -> tuple[DataFrame, Observation | None]:
    """The rows of a source that give a record, and whether a pass over them has met others (``n`` above 0).

    The others fail the job if the stream is set to."""
    if "reason" not in source.columns:
        return source, None
    unread = Observation("lines without a record")
    counted = _checked(source, cfg).observe(unread, F.count_if(F.col("reason").isNotNull()).alias("n"))
    return counted.filter("reason IS NULL").drop("raw", "reason"), unread


def _checked(source: DataFrame, cfg: StreamConfig) -> DataFrame:
    """A source whose lines without a record fail the job if the stream is set to."""
    if "reason" not in source.columns or cfg.on_bad != "fail":
        return source
    message = F.concat(F.lit("a line of the source "), F.col("reason"))
    return source.filter(
        F.when(F.col("reason").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    )


def outcomes_of(
    source: DataFrame,
    cfg: StreamConfig,
    bookmark: DataFrame | None,
    schema: dict,
    run_ts: str,
    refresh: bool = False,
    disambiguate: bool = False,
) -> DataFrame:
    """Outcome of every record of a source: the part of a run before anything is written.

    A source with a ``reason`` column gives the lines without a record as well, with their reason, in the
    same pass."""
    records = transform_all(_checked(source, cfg), cfg, run_ts, disambiguate)
    return O.route_outcomes(records, bookmark, schema, refresh, _hides(cfg))


def _hides(cfg: StreamConfig) -> bool:
    return bool(cfg.drop_field_paths or cfg.sensitive_field_paths)


def _against_bookmark(
    source: DataFrame, cfg: StreamConfig, table: BookmarkLog, previous: int, schema: dict, run_ts: str,
    disambiguate: bool, staged: str,
) -> DataFrame:
    """Outcomes against a version of the bookmark, of which only the run's own keys are read and joined.

    Typed records are scanned for their keys first, which reads the key's columns alone. VARIANT records are
    parsed once: what a run needs of them is written, and their keys are one column of it. Extraction keys are
    made of what is there behind the join, so they are neither written nor shuffled before."""
    records = transform_all(_checked(source, cfg), cfg, run_ts, disambiguate, stamped=False)
    if is_variant(records.schema["rec"].dataType):
        records = records.drop("rec", K.NATURAL_KEY)
        records.write.parquet(staged)
        records = source.sparkSession.read.schema(records.schema).parquet(staged)
    known = table.known(records, previous)
    return O.route_outcomes(records, known, schema, hide=_hides(cfg), disambiguate=disambiguate)


@dataclass
class _Run:
    """An extraction that has begun: what is written, and what it compares with."""

    cfg: StreamConfig
    store: StreamStore
    table: BookmarkLog
    schema: dict
    run_ts: str
    version: int
    previous: int
    last_update: str | None
    output: str
    routed: DataFrame
    started: float


def _begin(
    source: DataFrame, cfg: StreamConfig, store: Store, run_ts: str | None = None, refresh: bool = False,
    disambiguate: bool = False, version: int | None = None, previous: int | None = None,
) -> _Run:
    started = time.monotonic()
    run_ts, store = run_ts or now_text(), store.of(cfg.stream_name)
    schema = load_schema(store.catalog.read(), cfg.stream_name)
    if schema is None:
        raise ValueError(f"stream {cfg.stream_name} has no catalog; run discovery first")
    table = store.bookmark
    check_settings(source.sparkSession)
    info = table.info() or {}
    previous = info.get("version", 0) if previous is None else previous
    version = previous + 1 if version is None else version
    output = store.output(version)
    if previous and not refresh:
        staged = f"{output}/records"
        routed = _against_bookmark(source, cfg, table, previous, schema, run_ts, disambiguate, staged)
    else:
        routed = outcomes_of(source, cfg, None, schema, run_ts, refresh, disambiguate)
    return _Run(cfg, store, table, schema, run_ts, version, previous, info.get("updated_at"), output, routed, started)


def _finish(
    run: _Run, outcomes: DataFrame, metrics: dict, replay: bool = False, keep_versions: int | None = None,
    outputs: tuple[str, ...] = (), **facts,
) -> RunResult:
    """Write what follows from a run's written outcomes, and commit."""
    messages, quarantine = f"{run.output}/messages", f"{run.output}/rejects"

    def write_messages() -> None:
        built = (run.store.catalog.info() or {}).get("schema_message")
        if built:
            first = outcomes.sparkSession.read.text(built)
        else:
            first = M.schema_messages(run.store.catalog.read()).select("message")
        first.write.text(f"{messages}/schema")
        emitted = outcomes.filter(F.col("outcome") == O.EMITTED)
        M.record_messages(emitted).select("message").write.options(**MESSAGE_FILES).text(f"{messages}/records")

    def write_rejects() -> None:
        O.rejects(outcomes, run.schema).unionByName(O.unreadable_rejects(outcomes)).write.parquet(quarantine)

    def write_bookmark() -> str:
        updates = metrics[O.EMITTED] + metrics[O.FILTERED]
        folded = B.fold_updates(B.bookmark_updates(outcomes), run.cfg.stream_name)
        return run.table.advance(folded, run.version, run.previous, updates)

    # Three independent jobs over the written outcomes; the first error of any ends the run.
    with ThreadPoolExecutor(max_workers=3) as pool:
        jobs = [pool.submit(f) for f in (write_bookmark, write_rejects, write_messages)]
    path, *_ = [job.result() for job in jobs]
    duration = time.monotonic() - run.started
    metrics = metrics | {"duration_s": duration, "processed_per_second": metrics["processed"] / duration}
    run.table.commit(
        run.version,
        path,
        replay=replay,
        previous=run.previous,
        last_extraction_started_at=run.run_ts,
        last_extraction_ended_at=now_text(),
        updated_at=run.run_ts if metrics["emitted"] + metrics["filtered_bookmark"] else run.last_update,
        metrics=metrics,
        outputs=[run.output, *outputs],
        **facts,
    )
    if keep_versions is not None:
        run.table.retain(keep_versions)
    return RunResult(run.version, messages, quarantine, metrics)


def run_extract(
    source: DataFrame,
    cfg: StreamConfig,
    store: Store,
    run_ts: str | None = None,
    refresh: bool = False,
    disambiguate: bool = False,
    version: int | None = None,
    previous: int | None = None,
    replay: bool = False,
    keep_versions: int | None = None,
    **facts,
) -> RunResult:
    """Emit new and changed records, and advance the bookmark.

    The bookmark becomes current after all output is written: a run that fails midway can be repeated
    and gives the same records again. ``version`` and ``previous`` name the bookmark versions to
    write and to compare with, and ``replay`` says that an earlier try of this run may have committed;
    ``facts`` are stored with the version. Of two runs that began from one version the second raises
    StaleRun. ``keep_versions`` deletes older versions with their output afterwards."""
    run = _begin(source, cfg, store, run_ts, refresh, disambiguate, version, previous)
    routed, counts = X.observed(run.routed)
    uri = f"{run.output}/outcomes"
    # The outcome is a folder, so emitted, rejected and unchanged records are read apart.
    routed.write.partitionBy("outcome").parquet(uri)
    outcomes = source.sparkSession.read.schema(OUTCOMES_SCHEMA).parquet(uri)
    return _finish(run, outcomes, X.metrics_of(counts), replay, keep_versions, **facts)


def run_extract_many(
    sources: Sequence[tuple[DataFrame, StreamConfig]], store: Store, run_ts: str | None = None,
    refresh: bool = False, keep_versions: int | None = None,
) -> dict[str, RunResult]:
    """run_extract over several streams, the outcomes of which one job writes.

    Each stream's records are routed by its own rules, into one frame, and its outcomes are folders of it; small
    streams fill a cluster together. Bookmarks, messages and rejects are those of separate runs, and
    each stream commits for itself: one that fails afterwards leaves the others done. Streams are named once."""
    names = [cfg.stream_name for _, cfg in sources]
    if len(set(names)) < len(names):
        raise ValueError(f"a stream is named twice: {sorted(names)}")
    if not sources:
        return {}
    run_ts = run_ts or now_text()
    with ThreadPoolExecutor(max_workers=4) as pool:
        runs = list(pool.map(lambda s: _begin(s[0], s[1], store, run_ts, refresh), sources))
    routed = runs[0].routed
    for run in runs[1:]:
        routed = routed.unionByName(run.routed, allowMissingColumns=True)
    routed, counts = X.observed(routed, names)
    uri = f"{store.uri}/runs-of-many/{uuid.uuid4().hex}"
    routed.write.partitionBy("stream", "outcome").parquet(uri)
    outcomes = store.spark.read.schema(OUTCOMES_SCHEMA).parquet(uri)

    def finish(run: _Run) -> RunResult:
        name = run.cfg.stream_name
        own = outcomes.filter(F.col("stream") == name)
        return _finish(run, own, X.metrics_of(counts, name), keep_versions=keep_versions)

    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(names, pool.map(finish, runs)))


def run_refresh(source: DataFrame, cfg: StreamConfig, store: Store, **options) -> RunResult:
    """As run_extract, but every valid record is emitted; the bookmark is advanced all the same."""
    return run_extract(source, cfg, store, refresh=True, **options)


__all__ = [
    "RunResult", "outcomes_of", "read_pages", "read_source", "run_discover", "run_discover_many", "run_extract",
    "run_extract_many", "run_refresh",
]

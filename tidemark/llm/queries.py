"""The numbered operators over the driver's tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    lexical,
    licenses,
    line_runs,
    neighbours,
    packing,
    periods,
    pieces,
    quality,
    sharding,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from tidemark.llm.common import table, text_or_empty

MOST_TOKENS = 2048


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which rule came first depends on measured costs; the verdict doesn't.
    return quality.quality(table(spark, sf_dir, "documents")).drop("first_rule")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(table(spark, sf_dir, "documents"), path, with_ids=False)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > MOST_TOKENS)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def planted_loops(docs: DataFrame) -> DataFrame:
    """doc_id, text; in a tenth of the documents, by the hash of their id, the words repeat from some place on."""
    words = F.filter(F.split(text_or_empty(), "[\\x09-\\x0D ]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("bigint")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    loops = F.expr(
        "concat(slice(words, 1, int(a)), slice(flatten(array_repeat(slice(words, int(a) + 1, int(p)),"
        " int((n - a + p - 1) div p))), 1, int(n - a)))"
    )
    return rows.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", loops)).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> list[Column]:
    """Of a document's runs: their number, the longest, and a digest of them all."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("n"), (-r.start).alias("s"), (-r.period).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return [
        F.size("runs").cast("bigint").alias("n_runs"), (-longest.s).alias("start"), longest.n.alias("length"), (-longest.q).alias("period"),
        F.floor(1000 * longest.n / -longest.q).alias("exponent_milli"), F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
    ]


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(planted_loops(table(spark, sf_dir, "documents")))
    return found.select("doc_id", *run_digests(found), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=20)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_sharding": op2_sharding,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_neighbours": op5_neighbours,
    "op6_licenses": op6_licenses,
    "op7_quality": op7_quality,
    "op8_pieces": op8_pieces,
    "op9_warc": op9_warc,
    "op10_token_counts": op10_token_counts,
    "op11_line_dedup": op11_line_dedup,
    "op12_periods": op12_periods,
    "op13_lexical": op13_lexical,
}
SPACE, NO_SPACE = r"[\x09-\x0D ]", r"[^\x09-\x0D ]"

QUALITY_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{NO_SPACE}')) AS l,
         length(regexp_replace(text, '{SPACE}', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
g AS (SELECT r, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM t, range(3) AS s(k) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, word_chars, n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         len(list_distinct(w)) AS different, len(list_filter(w, lambda x: length(x) > 1000)) AS long_words
  FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 1.5 * n_words OR word_chars > 30 * n_words OR n_symbols > 0.3 * n_words
            OR n_dup_lines > 0.5 * n_lines OR different * different < 4 * n_words OR long_words > 0) AS kept
FROM b"""

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
v AS (SELECT *, list_transform(range(8), lambda g: CAST('0x' || substr(h, CAST(5 * g + 1 AS INT), 5) AS BIGINT)) AS v,
             min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0],
         lambda s: substr('{LETTERS}', CAST((x >> CAST(s AS INT)) % 32 + 1 AS INT), 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM v"""

LINES_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(doc_id <> keeper, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r"""

TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
LEXICAL_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS terms FROM documents),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
q AS (SELECT item_id, term, count(*) AS k FROM (SELECT item_id, unnest({TERMS}) AS term FROM benchmark) GROUP BY ALL),
t AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM t, c GROUP BY term),
s AS (SELECT item_id, r, doc_id,
             CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN t USING (term), c GROUP BY ALL),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20"""

ORACLE: dict[str, str] = {
    "op7_quality": QUALITY_SQL,
    "op9_warc": WARC_SQL,
    "op11_line_dedup": LINES_SQL,
    "op13_lexical": LEXICAL_SQL,
}

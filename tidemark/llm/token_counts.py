"""Token counts from a digest cache.

A text's key is the digest of its normalised content and the digest of the tokenizer file. Keys that
the cache holds cost one narrow join; of the others each distinct content is encoded once, by Spark
tasks, and appended to the cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, freeze, in_batches, text_or_empty
from tidemark.session import scratch_uri

CACHE = "tokenizer string, digest string, n_tokens bigint"
# Single spaces are left alone: they are most matches of a plain "run of white space".
SPACE_RUNS = r"[ \t\n\x0B\f\r]{2,}|[\t\n\x0B\f\r]"


def tokenizer_version(path: str) -> str:
    """Digest of a tokenizer file; a changed file has its own cache entries."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def count_tokens(texts: DataFrame, tokenizer_path: str) -> DataFrame:
    """n_tokens of each row of (digest, text), by the library as it comes, without added tokens.

    For tokenizers that split at white space and drop it. Words between spaces are encoded once per
    task as long as they stay in its memo."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        memo = Memo(lambda word: len(tokenizer.encode(word, add_special_tokens=False).ids))
        for batch in batches:
            digests, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            counts: list[int] = []
            for a, b in in_batches(texts):
                counts += [sum(map(memo.__getitem__, t.split(" "))) for t in texts[a:b]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.string()), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
            )

    return texts.select("digest", "text").mapInArrow(count, "digest string, n_tokens bigint")


def read_cache(spark: SparkSession, uri: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one per digest. A folder not yet written is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest string, n_tokens bigint")
    stored = spark.read.schema(CACHE).parquet(uri).filter(F.col("tokenizer") == version)
    # Two runs that append at once may store the same content twice, with the same count.
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer_path: str, cache_uri: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every whole text; appends distinct misses to the cache.

    Null texts count as empty ones: 0 bytes and 0 tokens. Normalised content has each run of ASCII
    white space as one space, which such a tokenizer does itself, so equal digests have equal
    counts. Repeated rows and doc_ids stay as they are; other columns are not read. An empty table gives
    an empty result. Without `cache_uri` a new cache is made in the shared folder."""
    spark = docs.sparkSession
    cache_uri = cache_uri or scratch_uri(spark, "token-cache")
    version = tokenizer_version(tokenizer_path)
    content = F.regexp_replace(text_or_empty(), SPACE_RUNS, " ")
    contents = docs.select(
        "doc_id", F.octet_length(text_or_empty()).cast("bigint").alias("n_bytes"),
        content.alias("text"), F.sha2(content, 256).alias("digest"),
    )
    keyed = freeze(contents.drop("text"), "digests")
    cache = read_cache(spark, cache_uri, version)
    # Copies fold before the shuffle as well as after it, so a crowded digest brings a row a task; all texts
    # of a digest are equal.
    distinct = contents.groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(cache, "digest", "left_anti")
    (
        count_tokens(misses, tokenizer_path)
        .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
        .write.mode("append").parquet(cache_uri)
    )
    # As many rows as there are different contents. Read from a table, both sides of the join are plain
    # exchanges, of which a crowded digest is split.
    own = keyed.select("digest").distinct()
    counts = freeze(read_cache(spark, cache_uri, version).join(own, "digest", "left_semi"), "counts")
    return keyed.join(counts, "digest", "left").select("doc_id", "n_bytes", "n_tokens")

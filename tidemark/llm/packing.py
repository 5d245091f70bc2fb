"""Packing: shortest-pack-first over the length histogram.

Documents become token pieces of at most the sequence length. The histogram of piece lengths (as many
rows as lengths, whatever the corpus) is packed on the driver: lengths from the longest, each into the
packs that are shortest so far, as counts of patterns and not as single packs. Each (pattern, length)
then owns a range of ranks of that length, and pieces find their sequence by a join on length and rank.
The broadcast side has at most a row per pattern and length, which the sequence length bounds.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, freeze, in_batches, rank_within, slices, text_or_empty

SEQUENCE = 2048
END_ID = 1
# Fixed value: how byte-level BPE of this kind cuts text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The encoder's search for words takes memory for each character of a run of white space, and ends the process at
# some hundred thousands. The library takes such runs.
LONG_SPACE = re.compile(r"\s{10000}")


def chunks_at_spaces(text: str) -> list[str]:
    """Cut a text before each space that follows a character other than white space.

    Byte-level BPE splits words there in any case, and what it does on either side doesn't depend on
    the other, so the ids of the chunks are the ids of the text. All chunks but the first had a
    space before them, which is left off."""
    parts = text.split(" ")
    if all(parts[:-1]) and not any(p[-1].isspace() for p in parts[:-1] if p):
        return parts
    out, run = [], [parts[0]]
    for part in parts[1:]:
        if not run[-1] or run[-1][-1].isspace():
            run.append(part)
        else:
            out.append(" ".join(run))
            run = [part]
    return [*out, " ".join(run)]


def byte_ranks(tokenizer_path: str) -> dict[bytes, int]:
    """Ids of a byte-level BPE file's byte strings; raises unless merges are ranked by their ids.

    That is what lets another encoder of the same kind give the same ids."""
    with open(tokenizer_path, encoding="utf-8") as file:
        told = json.load(file)
    model, added = told["model"], {t["content"] for t in told["added_tokens"]}
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letter = {chr(b): b for b in plain} | {
        chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)
    }
    vocabulary = {bytes(letter[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    if model["type"] != "BPE" or ids != sorted(ids) or len(ids) + 256 != len(vocabulary):
        raise ValueError("not a byte-level BPE with merges in the order of their ids")
    return vocabulary


def token_pieces(
    docs: DataFrame, tokenizer_path: str, max_length: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most `max_length` ids; a document's ids end with `end_id`.

    A null text is an empty one and gives one piece with the end id. Only doc_id and text are read,
    so other columns may have any name. Returns doc_id, start, length, ids_crc32, doc_tokens and, if
    asked for, ids. Words are encoded once per task as long as they stay in its memo. Runs of one character
    of any length are encoded whole, in time that grows with them."""
    ranks = byte_ranks(tokenizer_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import array
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        encoder = tiktoken.Encoding("bpe", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

        def ids(text: str) -> bytes:
            if any(s in text for s in special) or LONG_SPACE.search(text):
                return array.array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            return array.array("I", encoder.encode_ordinary(text)).tobytes()

        first, rest = Memo(ids), Memo(lambda text: ids(" " + text))
        end = array.array("I", [end_id]).tobytes()
        step = 4 * max_length
        for batch in slices(batches):
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in in_batches(texts):
                out: list[list] = [[], [], [], [], [], []]
                for key, text in zip(keys[a:b], texts[a:b]):
                    part = chunks_at_spaces(text)
                    data = b"".join([first[part[0]], *map(rest.__getitem__, part[1:]), end])
                    for at in range(0, len(data), step):
                        piece = data[at : at + step]
                        row = (key, at // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4)
                        for column, value in zip(out, row):
                            column.append(value)
                        if with_ids:
                            out[5].append(array.array("I", piece).tolist())
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())]
                n = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(out[:n], kinds)], names=names[:n]
                )

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    schema += ", ids array<int>" * with_ids
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(encode, schema)


def shortest_pack_first(histogram: dict[int, int], max_length: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (count of packs, [(length, times), ...]), longest lengths first.

    A length goes into the shortest packs that there are, and opens new packs where these have no
    room. Packs that look alike are one entry with a count. Several copies go into a pack at once as
    long as it would stay the shortest anyway."""
    heap: list[tuple[int, int, int, tuple]] = []  # total length, tie-breaker, count, pattern
    done: list[tuple[int, tuple]] = []
    made = 0

    def put(total: int, count: int, pattern: tuple) -> None:
        nonlocal made
        if count:
            made += 1
            heapq.heappush(heap, (total, made, count, pattern))

    def with_more(pattern: tuple, length: int, times: int) -> tuple:
        if pattern and pattern[-1][0] == length:
            return (*pattern[:-1], (length, pattern[-1][1] + times))
        return (*pattern, (length, times))

    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        left = histogram[length]
        while left:
            if not heap or heap[0][0] + length > max_length:
                # No room anywhere. A new pack is the shortest one until it is full.
                times = max_length // length
                put(length * times, left // times, ((length, times),))
                if left % times:
                    put(length * (left % times), 1, ((length, left % times),))
                break
            total, _, count, pattern = heapq.heappop(heap)
            if left < count:
                put(total, count - left, pattern)
                put(total + length, left, with_more(pattern, length, 1))
                break
            upto = min(heap[0][0] if heap else max_length, max_length)
            times = max(1, min((upto - total) // length, (max_length - total) // length, left // count))
            left -= times * count
            put(total + length * times, count, with_more(pattern, length, times))
    done.extend((count, pattern) for _, _, count, pattern in sorted(heap))
    return [(count, list(pattern)) for count, pattern in done]


def slot_ranges(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple]:
    """(length, first rank, ranks' end, copies in a pack, first sequence, first offset)."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length, times in pattern:
            low = used.get(length, 0)
            used[length] = low + count * times
            out.append((length, low, low + count * times, times, sequence, offset))
            offset += length * times
        sequence += count
    return out


def pack(docs: DataFrame, tokenizer_path: str, max_length: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Place every token piece: adds sequence_id (from 0) and offset to `token_pieces`.

    An empty table gives an empty result. Repeated rows are packed as often as they occur. Pieces of
    one length are interchangeable; ties in rank fall to doc_id, start, the ids' digest, and then the scan."""
    spark = docs.sparkSession
    # Numbered before they are written, so that rows which repeat are dealt apart.
    dealt = F.monotonically_increasing_id().alias("_deal")
    pieces = freeze(token_pieces(docs, tokenizer_path, max_length, end_id, with_ids).select("*", dealt), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    ranges = slot_ranges(shortest_pack_first(histogram, max_length))
    slots = spark.createDataFrame(
        ranges, "length bigint, _low bigint, _high bigint, _times bigint, _sequence bigint, _offset bigint"
    )
    ranked = rank_within(pieces, "length", ["doc_id", "start", "ids_crc32", "doc_tokens", "_deal"], "_rank", sum(histogram.values()))
    at = F.col("_rank") - F.col("_low")
    return (
        ranked.join(
            F.broadcast(slots.withColumnRenamed("length", "_length")),
            (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")),
        )
        .withColumn("sequence_id", F.col("_sequence") + F.expr("(_rank - _low) div _times"))
        .withColumn("offset", F.col("_offset") + (at % F.col("_times")) * F.col("length"))
        .drop("_length", "_low", "_high", "_times", "_sequence", "_offset", "_rank", "_deal")
    )

"""License scans by diagonal voting, in built-in functions only.

All rolling word k-grams of a text are hashed, to 128 bits, and joined to the grams of the templates. A hit at word p of
the text and word q of a template votes for the diagonal p - q. Votes are summed per diagonal, neighbouring
diagonals (a word more or less) are merged, and the span of what remains is verified. A template of k words
or fewer has one gram, and each of its hits is a whole place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty
from tidemark.llm.quality import barrier

GRAM = 3
#: Seeds of the two hashes of a gram: 128 bits stand for its words.
HASHES = {"h1": 1, "h2": 2}
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Phrases whose places are counted, and license notices as their licenses word them.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
NOTICES = {
    "agpl": "under the terms of the gnu affero general public license as published by the free software foundation",
    "apache-2.0": "licensed under the apache license version 2 0",
    "artistic-2.0": "this package is licensed under the artistic license 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights",
    "creative-commons": "this work is licensed under a creative commons attribution 4 0 international license",
    "epl-2.0": "made available under the terms of the eclipse public license 2 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "redistribute it and or modify it under the terms of the gnu general public license as published by "
    "the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted",
    "lgpl": "under the terms of the gnu lesser general public license as published by the free software foundation",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files",
    "mit-short": "released under the mit license",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    base: bool

    @property
    def gram(self) -> int:
        return min(GRAM, len(self.words))


def templates(base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> list[Template]:
    made = [Template(k, tuple(v.split()), True) for k, v in base.items()]
    return made + [Template(k, tuple(v.split()), False) for k, v in notices.items()]


def scan(docs: DataFrame, against: list[Template] | None = None, slack: int = 3, cover: float = 0.8) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, spans, score of every row.

    Words are runs of letters and digits in lower case, after which only ASCII words can equal a
    phrase's. `spans` are (label, first word, end, share of the template) of verified places. A notice is
    found where merged diagonals cover `cover` of its grams within a span of the right length.
    score is 1 with a base place, else the largest cover found. Null texts are empty ones. Repeated rows stay apart, by their
    places in the scan, so `docs` should be a table or written frame; other columns are not read. An empty
    table gives an empty result. A phrase's length is at most the gram's."""
    against = templates() if against is None else against
    if any(t.base and len(t.words) > GRAM for t in against):
        raise ValueError(f"a base phrase has at most {GRAM} words")
    widths = sorted({t.gram for t in against})
    spark = docs.sparkSession
    grams = [
        (n, q, t.gram, list(t.words[q : q + t.gram]))
        for n, t in enumerate(against) for q in range(len(t.words) - t.gram + 1)
    ]
    # As many rows as the templates have words.
    known = spark.createDataFrame(grams, "template int, q int, width int, gram array<string>")
    for name, seed in HASHES.items():
        words = lambda w: [F.col("gram")[i] for i in range(w)]
        each = [F.when(F.col("width") == w, F.xxhash64(F.lit(seed), *words(w))) for w in widths]
        known = known.withColumn(f"gram_{name}", F.coalesce(*each))
    split = F.array_remove(F.split(F.lower(text_or_empty()), BREAKS), "")
    rows = barrier(
        docs.select("doc_id", F.col("text"), F.monotonically_increasing_id().alias("row")), words=split
    ).select("row", "doc_id", "words", F.size("words").alias("n"))
    none, kind = "named_struct('h1', 0L, 'h2', 0L)", "array<struct<h1: bigint, h2: bigint>>"
    hashes = [F.expr(f"array({none})")]  # position 0 stands for the row itself
    for w in widths:
        args = ", ".join(f"words[i + {k}]" for k in range(w))
        both = ", ".join(f"'{name}', xxhash64({seed}, {args})" for name, seed in HASHES.items())
        hashes.append(F.expr(f"if(n >= {w}, transform(sequence(0, n - {w}), i -> named_struct({both})), cast(array() as {kind}))"))
    # A gram leaves the text as its hashes alone, so a text of n words gives rows of a bounded size.
    opened = rows.select("row", "doc_id", "n", F.posexplode(F.concat(*hashes)).alias("at", "h"))
    opened = opened.select("row", "doc_id", "n", "at", "h.h1", "h.h2")
    p, width = F.col("at") - 1, F.lit(0)
    begin = F.lit(1)
    for w in widths:
        here = F.col("at") >= begin
        p, width = F.when(here, F.col("at") - begin).otherwise(p), F.when(here, w).otherwise(width)
        begin = begin + F.greatest(F.col("n") - (w - 1), F.lit(0))
    opened = opened.withColumns({"p": p, "width_at": width})
    hits = opened.join(
        F.broadcast(known),
        (F.col("h1") == F.col("gram_h1")) & (F.col("h2") == F.col("gram_h2")) & (F.col("width_at") == F.col("width")), "left",
    ).filter("at = 0 or gram is not null")
    votes = (
        hits.select("row", "doc_id", "n", F.when(F.col("at") > 0, F.col("template")).alias("template"), "p",
                    (F.col("p") - F.col("q")).alias("diagonal"))
        .groupBy("row", "doc_id", "n", "template", "diagonal")
        .agg(F.count(F.lit(1)).alias("votes"), F.min("p").alias("low"), F.max("p").alias("high"))
    )
    near = W.partitionBy("row", "doc_id", "n", "template").orderBy("diagonal")
    fixed = spark.createDataFrame(
        [(n, t.label, t.base, len(t.words), t.gram) for n, t in enumerate(against)],
        "template int, label string, base boolean, length int, width int",
    )
    voted = votes.join(F.broadcast(fixed), "template", "left")
    opens = F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(near) > slack)
    merged = (
        voted.withColumn("part", F.sum(F.coalesce(opens, F.lit(True)).cast("int")).over(near))
        .groupBy("row", "doc_id", "n", "template", "part", "label", "base", "length", "width")
        .agg(F.sum("votes").alias("votes"), F.min("low").alias("low"), (F.max("high") + F.first("width")).alias("end"))
        .withColumn("share", F.least(F.lit(1.0), F.col("votes") / (F.col("length") - F.col("width") + 1)))
    )
    fits = F.col("end") - F.col("low") <= F.col("length") + slack
    found = F.coalesce(F.col("base") | ((F.col("share") >= cover) & fits), F.lit(False))
    placed = F.col("base") & found
    labels = lambda which: F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")
    span = F.struct("label", F.col("low").alias("first_word"), "end", "share")
    return merged.groupBy("row", "doc_id", "n").agg(
        F.count_if(placed).alias("n_base"),
        F.min(F.when(placed, F.col("low"))).cast("bigint").alias("first_word"),
        F.max(F.when(placed, F.col("low"))).cast("bigint").alias("last_word"),
        labels(placed).alias("base_labels"), labels(found).alias("labels"),
        F.sort_array(F.collect_list(F.when(found, span))).alias("spans"),
        F.coalesce(F.max(F.when(placed, 1.0).when(found, F.col("share"))), F.lit(0.0)).alias("score"),
    ).select(
        "doc_id", F.col("n").cast("bigint").alias("n_words"), "n_base", "first_word", "last_word", "base_labels",
        "labels", "spans", "score",
    )

"""Quality rules as a short-circuit cascade, in built-in functions only.

A rule is a condition on measures of the text, and its cost is that of the measures and the condition. Cost and
selectivity are estimated on a sample. Rules then run in the order of rejections per cost. A row leaves the cascade
at the first rule that rejects it: what later rules measure is null there and isn't computed. The order
changes what is evaluated and `first_rule`, never `kept`.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import freeze, text_or_empty

SPACE = "[\\x09-\\x0D ]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """`rejects` is SQL over the measures that `needs` names."""

    name: str
    needs: tuple[str, ...]
    rejects: str


#: What the contract's base rejects, and thresholds that reject what is broken and leave prose with some code, figures
#: or links alone. Prose has far more different words than twice the square root of its length.
RULES = (
    Rule("few_words", ("n_words",), "n_words < 50"),
    Rule("repeated_words", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 50 * n_words"),
    Rule("mean_word_short", ("n_words", "word_chars"), "word_chars < 1.5 * n_words"),
    Rule("mean_word_long", ("n_words", "word_chars"), "word_chars > 30 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "n_symbols > 0.3 * n_words"),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), "n_dup_lines > 0.5 * n_lines"),
    Rule("few_different_words", ("n_words", "n_different"), "n_different * n_different < 4 * n_words"),
    Rule("long_word", ("longest_word",), "longest_word > 1000"),
)
BASE = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def barrier(df: DataFrame, **made: Column) -> DataFrame:
    """Add columns that are computed once, whatever uses them: nothing is moved past a generator."""
    one = F.array(F.struct(*[c.alias(n) for n, c in made.items()]))
    return df.select("*", F.inline(one))


def _lines() -> Column:
    return F.filter(F.split("text", "\n", -1), lambda line: F.translate(line, SPACES, "") != "")


def _windows() -> Column:
    hashed = "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))"
    return F.when(F.size("words") >= WINDOW, F.expr(hashed)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _ordered() -> Column:
    """Windows with their places in the order of their hashes; null where none is repeated."""
    return F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )


def _covered() -> Column:
    """How many words stand in repeated windows."""
    # Neighbours in the order of their hashes that have the same hash: both windows are repeated.
    pairs = F.filter(
        F.zip_with(
            "ordered", F.slice("ordered", F.lit(2), F.size("ordered")),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        ),
        lambda p: p.isNotNull(),
    )
    covered = F.aggregate(
        F.array_sort(F.array_distinct(F.flatten(pairs))),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("total")),
        lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total")),
        lambda a: a["total"],
    )
    return F.when(F.col("ordered").isNotNull(), covered).otherwise(F.lit(0).cast("bigint"))


#: Each measure with those it is computed from, besides the text: n_words, word_chars (code points in words), n_symbols,
#: n_lines (with a word), n_dup_lines (equal to an earlier one), n_repeat_words (words in three-word windows that
#: occur twice or more), n_different words, longest_word.
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "word_chars": ((), lambda: F.length(F.translate("text", SPACES, "")).cast("bigint")),
    "n_symbols": ((), lambda: (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint")),
    "words": ((), lambda: F.array_remove(F.split("text", SPACE), "")),
    "n_words": (("words",), lambda: F.size("words").cast("bigint")),
    "n_different": (("words",), lambda: F.size(F.array_distinct("words")).cast("bigint")),
    "longest_word": (("words",), lambda: F.coalesce(F.array_max(F.transform("words", F.length)), F.lit(0))),
    "lines": ((), _lines),
    "n_lines": (("lines",), lambda: F.size("lines").cast("bigint")),
    "n_dup_lines": (("lines",), lambda: (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint")),
    "windows": (("words",), _windows),
    "ordered": (("windows",), _ordered),
    "n_repeat_words": (("ordered",), _covered),
}


def _steps(needs: tuple[str, ...], have: set[str]) -> list[list[str]]:
    """Measures that `needs` lack, those of a step computed from earlier ones."""
    steps, have = [], set(have)
    wanted = list(needs)
    for name in wanted:
        wanted += [n for n in MEASURES[name][0] if n not in wanted]
    while left := [n for n in wanted if n not in have]:
        step = [n for n in left if have.issuperset(MEASURES[n][0])]
        steps.append(sorted(step))
        have |= set(step)
    return steps


def cascade(rows: DataFrame, rules: list[Rule] | tuple[Rule, ...], always: tuple[str, ...] = ()) -> DataFrame:
    """Adds first_rule (null where no rule rejects) and measures to rows with a column `text` and none named like
    these.

    Measures outside `always` are computed only where no earlier rule has rejected the row."""
    df, have = rows, set()
    for step in _steps(always, have):
        df = barrier(df, **{n: MEASURES[n][1]() for n in step})
        have |= set(step)
    df = df.withColumn("first_rule", F.lit(None).cast("string"))
    first, open_ = F.col("first_rule"), False
    for rule in rules:
        steps = _steps(rule.needs, have)
        if steps and open_:
            df = barrier(df, _first=first).drop("first_rule").withColumnRenamed("_first", "first_rule")
            first, open_ = F.col("first_rule"), False
        for step in steps:
            df = barrier(df, **{n: F.when(F.col("first_rule").isNull(), MEASURES[n][1]()) for n in step})
            have |= set(step)
        rejected = F.coalesce(F.expr(rule.rejects), F.lit(False))
        first, open_ = F.when(first.isNotNull(), first).when(rejected, F.lit(rule.name)), True
    return df.withColumn("first_rule", first)


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> list[Rule]:
    """Rules by rejections per second on a sample, best first."""
    return [rule for rule, *_ in timed_rules(docs, rules, sample_rows)]


def timed_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> list[tuple[Rule, int, float]]:
    """(rule, rejected rows, seconds) on a sample, best first.

    The sample has the `sample_rows` rows with the smallest hashes of doc_id (and what shares them). Each rule runs
    over its texts by itself, with its own measures, three times, of which the quickest counts, less what a pass
    without a rule takes. Those that reject nothing come last, the cheapest first."""
    key = F.xxhash64(F.col("doc_id").cast("string"))
    # Bounded by sample_rows, so it can be sent to every executor.
    chosen = docs.select(key.alias("key")).distinct().orderBy("key").limit(sample_rows)
    rows = docs.select(key.alias("key"), text_or_empty().alias("text"))
    sample = freeze(rows.join(F.broadcast(chosen), "key", "left_semi").select("text"), "rule-sample")

    def run(some: tuple[Rule, ...]) -> tuple[int, float]:
        counted = cascade(sample, some).agg(F.count("first_rule"), F.sum(F.length("text")))
        seconds = []
        for _ in range(3):
            began = time.perf_counter()
            rejected = counted.first()[0]
            seconds.append(time.perf_counter() - began)
        return rejected, min(seconds)

    idle = run(())[1]
    timed = [(rule, *run((rule,))) for rule in rules]
    timed = [(rule, n, max(seconds - idle, 1e-4)) for rule, n, seconds in timed]
    return sorted(timed, key=lambda x: (-x[1] / x[2], x[2], x[0].name))


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """doc_id, the measures, base_failed, kept and first_rule (the rule that rejected, or null).

    The measures returned are computed in every row. Null and empty texts have no words and fail the base.
    Repeated rows stay; other columns are not read. An empty table gives an empty result."""
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    judged = cascade(rows, order_rules(docs, rules, sample_rows), shown)
    return judged.select(
        "doc_id", *shown, F.expr(BASE).alias("base_failed"), F.col("first_rule").isNull().alias("kept"), "first_rule"
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """The rows of `docs` that pass, with all their columns, without a shuffle."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), text_or_empty().alias("text"))
    return cascade(rows, order_rules(docs, rules, sample_rows)).filter("first_rule is null").select("_row.*")

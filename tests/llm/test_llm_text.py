"""Toxicity, license scans and quality rules against brute force and held-out labels."""

import random
import re
from collections import Counter

import pytest

from tidemark.llm import licenses, quality, toxicity

SF = "/root/testdata/sf0.01"
INSULTS = ["grobnik", "slarvot", "frembul", "dastovik"]


@pytest.fixture(scope="module")
def labelled(vocabulary):
    """600 documents; a tenth of them abusive, one half of these by words that begin alike."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        words, bad = [rng.choice(vocabulary) for _ in range(rng.randint(20, 90))], i % 6 == 0
        for _ in range(rng.randint(1, 4) * bad):
            insult = rng.choice(INSULTS) if i % 12 else "zuvra" + rng.choice(vocabulary)
            words.insert(rng.randrange(len(words)), insult)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, labelled):
    rows, labels = labelled
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_scores_held_out_documents(spark, labelled, model):
    rows, labels = labelled
    got = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    import zlib

    held = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and sum(got[i] == t for i, t in held) >= 0.97 * len(held)


def test_misspelt_and_quoted(spark, model, vocabulary):
    plain = " ".join(vocabulary[:60])
    texts = {
        "clean": plain, "abuse": f"{plain} you grobnik and slarvot {plain}", "misspelt": f"{plain} you grobnlk slarvott frmbul {plain}",
        "quoted": f'{plain} he said "grobnik" {plain}', "bare": f"{plain} he is grobnik {plain}",
    }
    frame = spark.createDataFrame(list(enumerate(texts.values())), "doc_id bigint, text string")
    got = dict(zip(texts, [r.score for r in toxicity.score(frame, model).orderBy("doc_id").collect()]))
    assert got["clean"] < 0.5 < got["abuse"] and got["clean"] < got["misspelt"] and got["quoted"] < got["bare"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_machine_against_edit_distance():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    lexicon = {word(rng.randint(3, 8)): (rng.random() + 1, False) for _ in range(30)}
    machine = toxicity.Machine(lexicon)
    for _ in range(3000):
        w = word(rng.randint(1, 9))
        near = [v for t, (v, _) in lexicon.items() if len(t) >= 5 and distance(w, t) <= 1]
        want = ("exact", lexicon[w][0]) if w in lexicon else ("fuzzy", max(near)) if near else None
        assert machine.match(w) == want


def test_stems():
    machine = toxicity.Machine({"abcd": (2.0, True), "abcde": (3.0, False)})
    assert machine.match("abcdzz") == ("stem", 2.0) and machine.match("abcde") == ("exact", 3.0)
    assert machine.match("abc") is None and toxicity.Machine({}).match("abc") is None


def test_toxicity_odd_documents(spark, odd_docs, odd_texts, no_docs, model):
    rows = toxicity.score(odd_docs, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in odd_texts)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.keep_clean(odd_docs, model).columns == odd_docs.columns
    assert toxicity.score(no_docs, model).count() == 0 and toxicity.keep_clean(no_docs, model).count() == 0
    none = spark.createDataFrame([(None, 1, 1), (3, 0, None)], "doc_id bigint, quality int, toxic int")
    assert toxicity.train(odd_docs, none).lexicon == {}


def words6(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_licenses_against_brute_force(docs_of, odd_texts, vocabulary, no_docs):
    rng = random.Random(2)
    phrases = ["cc by", "general public license", "all rights reserved", "cc", "by", "general", "public", "CC-BY", "All Rights"]
    mixed = [(500 + i, " ".join(rng.choice(phrases + vocabulary[:5]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows_in = odd_texts + mixed
    want = Counter()
    for doc_id, text in rows_in:
        words, places, labels = words6(text), [], set()
        for label, phrase in licenses.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        want[doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))] += 1
    rows = licenses.scan(docs_of(rows_in)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)
    assert licenses.scan(no_docs).count() == 0


def test_notices_with_changes(docs_of, vocabulary):
    notice = licenses.NOTICES["mit"].split()
    pad = " ".join(vocabulary[:40])
    whole, inserted, half = notice[:], notice[:9] + ["really"] + notice[9:], notice[: len(notice) // 2]
    texts = [" ".join(["the", *t]) for t in (whole, inserted, half)]
    got = licenses.scan(docs_of([(i, f"{pad} {t} {pad}") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [r.labels for r in got] == ["mit", "mit", ""] and got[0].score == 1.0 > got[1].score >= 0.8
    assert (got[0].spans[0].first_word, got[0].spans[0].end) == (41, 41 + len(notice))


def test_licenses_of_long_texts(docs_of, vocabulary):
    """Seconds grow with a text's length, not with its square."""
    import time

    rng, seconds = random.Random(6), []
    scan = lambda n: licenses.scan(docs_of([(1, " ".join(rng.choice(vocabulary) for _ in range(n)) + " all rights reserved")])).first()
    scan(1000)
    for n in (50_000, 200_000):
        began = time.perf_counter()
        row = scan(n)
        seconds.append(time.perf_counter() - began)
        assert row.n_words == n + 3 and row.first_word == n and row.labels == "reserved"
    # Four times the words; sixteen times the seconds before grams left the text.
    assert seconds[1] < 8 * seconds[0] + 2


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        covered |= {i, i + 1, i + 2} if times[w] > 1 else set()
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, symbols = len(words), len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_quality_against_brute_force(odd_docs, odd_texts, no_docs):
    rows = quality.quality(odd_docs).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == Counter((i, *measured(t)) for i, t in odd_texts)
    assert all(not (r.base_failed and r.kept) and r.kept == (r.first_rule is None) for r in rows)
    assert quality.quality(no_docs).count() == 0
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.kept)


def test_order_of_rules_leaves_the_verdict(odd_docs):
    verdicts = [
        Counter((r.doc_id, r.kept) for r in quality.quality(odd_docs, rules).collect())
        for rules in (quality.RULES, quality.RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1]


def test_repeated_windows_that_overlap(docs_of):
    rows = [(i, t) for i, t in enumerate(["a a a a a", "a b c x a b c", "a b a b a b a", "q w e r", "a b c d a b c d e"])]
    got = {r.doc_id: r.n_repeat_words for r in quality.quality(docs_of(rows)).collect()}
    assert got == {i: measured(t)[4] for i, t in rows}


@pytest.mark.parametrize("n", [60, 1999, 2000, 200_000])
def test_few_different_words_at_any_length(docs_of, n):
    """Texts of few words are rejected and texts of many kept, however long they are."""
    rng = random.Random(3)
    few, many = int(1.5 * n**0.5), int(4 * n**0.5)
    rows = [(i, " ".join(f"word{rng.randrange(k)}" for _ in range(n))) for i, k in enumerate((few, many))]
    rules = [r for r in quality.RULES if r.name == "few_different_words"]
    got = quality.cascade(docs_of(rows).select("doc_id", "text"), rules).orderBy("doc_id").collect()
    assert [r.first_rule for r in got] == ["few_different_words", None]


def test_rejected_rows_are_not_measured_further(docs_of):
    """Measures of later rules are null where an earlier rule has rejected."""
    docs = docs_of([(1, "few words"), (2, " ".join(f"w{i}" for i in range(80)))]).select("doc_id", "text")
    done = quality.cascade(docs, quality.RULES).orderBy("doc_id").collect()
    assert done[0].first_rule == "few_words" and done[0].n_words == 2
    assert [done[0][m] for m in ("n_repeat_words", "word_chars", "n_symbols", "n_dup_lines", "n_different", "longest_word")] == [None] * 6
    assert done[1].first_rule is None and done[1].n_different == 80
    every = quality.cascade(docs, quality.RULES, ("n_repeat_words", "n_symbols")).orderBy("doc_id").first()
    assert (every.n_repeat_words, every.n_symbols, every.n_different) == (0, 0, None)


def test_order_is_by_rejections_a_second(docs_of):
    docs = docs_of([(i, "few words" if i % 2 else " ".join(f"w{i}x{j}" for j in range(80))) for i in range(40)])
    timed = quality.timed_rules(docs)
    rates = [n / seconds for _, n, seconds in timed]
    assert rates == sorted(rates, reverse=True) and {r.name: n for r, n, _ in timed}["few_words"] == 20

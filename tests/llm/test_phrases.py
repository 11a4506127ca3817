import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, clashing, documents
from pyspark.sql import functions as F

from strataframe.llm import phrases


def plain(rows, least, top, percent=100):
    """Rows of (lang, text): the contract word by word."""
    words, grams = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for size in range(1, 6):
                for i in range(len(w) - size + 1):
                    grams[lang, tuple(w[i:i + size])] += 1
    found = {key: n for key, n in grams.items() if n >= least and len(key[1]) > 1}
    covered = {}
    for (lang, longer), n in found.items():
        for size in range(2, len(longer)):
            for i in range(len(longer) - size + 1):
                key = lang, longer[i:i + size]
                covered[key] = max(covered.get(key, 0), n)
    out = {}
    for (lang, p), a in found.items():
        if 100 * covered.get((lang, p), 0) >= percent * a:
            continue
        cuts = [(1000 * a * words[lang] // (grams[lang, p[:k]] * grams[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((score, a, " ".join(p), grams[lang, p[:k]], grams[lang, p[k:]]))
    result = set()
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        result |= {(lang, i + 1, p, a, left, right, words[lang], s) for i, (s, a, p, left, right) in enumerate(found[:top])}
    return result


def rows_of(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def awkward():
    rng = random.Random(5)
    pool = ["New", "york", "city", "of", "the", "a", "é", "日本", "x\x00y", "old", "man"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(pool, weights=range(len(pool), 0, -1), k=rng.randint(0, 30)))
        text = re.sub(" ", lambda m: rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b"]), text)
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text))
    rows += [("en", None), ("en", ""), (None, None), ("fr", "..."), ("fr", "one two one two one two one two one two")]
    rows += [("en", "a hot pair " + rng.choice(pool)) for _ in range(400)]  # one key with much of all rows
    rows += [("en", "word " * 3000)] + [("es", "the same text, twice over")] * 40
    return rows


@pytest.mark.parametrize("budget", [7, 300, 1 << 17])
def test_counts_and_scores_are_those_of_a_plain_count(spark, budget):
    rows = awkward()
    docs = clashing(spark.createDataFrame([(i, t, l) for i, (l, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(5))
    for least, top in ((2, 100_000), (12, 20)):
        assert rows_of(phrases.collocations(docs, least=least, top=top, budget=budget)) == plain(rows, least, top)


def test_partial_cover(spark):
    rows = awkward()
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(phrases.collocations(docs, least=3, top=1000, cover_percent=60)) == plain(rows, 3, 1000, 60)


def test_odd_and_empty_tables(spark):
    docs = documents(spark, ODD)
    assert rows_of(phrases.collocations(docs, least=2, top=500)) == plain([("en", t) for _, t in ODD], 2, 500)
    none = phrases.collocations(docs.limit(0))
    assert none.count() == 0 and dict(none.dtypes)["score"] == "bigint"


def test_arithmetic_passes_64_bits(spark):
    names = [3, 5]
    big = 10 ** 15 + 7
    words = spark.createDataFrame([(3, "en", "p", big), (5, "en", "q", big + 2)], "name long, lang string, word string, n long")
    found = spark.createDataFrame([(names, big - 10)], "phrase array<long>, a long")
    row = phrases.scored(found, words, 100, 10, 100).first()
    assert row["score"] == 1000 * (big - 10) * (2 * big + 2) // (big * (big + 2)) and row["n"] == 2 * big + 2


def test_words_of_one_hash_take_another_seed(spark, monkeypatch):
    """Under seed 0 all words but one get one name."""
    docs = spark.createDataFrame([("en", "a b c a b c a b")], "lang string, text string")
    usual = phrases._count_words

    def weak(seed):
        def run(batches):
            import pyarrow as pa
            for out in usual(seed)(batches):
                yield out if seed else pa.RecordBatch.from_arrays([pa.array(np.ones(len(out), np.int64)), *out.columns[1:]], out.schema.names)
        return run

    monkeypatch.setattr(phrases, "_count_words", weak)
    words, seed = phrases.word_counts(docs)
    assert seed == 1 and {(r["word"], r["n"]) for r in words.collect()} == {("a", 3), ("b", 3), ("c", 2)}


def test_groups_keep_to_the_budget():
    totals = np.array([5, 0, 5, 1, 31, 2, 2, 10, 9])
    first, parts = phrases.prefix_groups(totals, 10)
    load = Counter()
    for i, total in enumerate(totals.tolist()):
        for p in range(parts[i]):
            load[first[i] + p] += -(-total // parts[i])
    assert max(load.values()) <= 10 and parts.tolist() == [1, 1, 1, 1, 4, 1, 1, 1, 1]
    assert not set(range(first[4], first[4] + 4)) & set(np.delete(first, 4).tolist())


def test_filter_keeps_all_that_it_was_given(spark):
    numbers = spark.range(5000).select(F.xxhash64("id").alias("x"))
    flags = phrases.Filter(numbers, "x")
    inside = np.array([r[0] for r in numbers.collect()], np.int64).view(np.uint64)
    outside = np.array([r[0] for r in spark.range(5000, 10000).select(F.xxhash64("id")).collect()], np.int64).view(np.uint64)
    assert flags(inside).all() and flags(outside).mean() < 0.1


def test_a_task_needs_little_memory_beside_its_rows():
    """17 MB of text in one batch: steps and what they pass on stay small in all three passes."""
    rng = np.random.default_rng(0)
    pool = np.array([f"w{k}" for k in range(5000)])
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 1000), pa.array([" ".join(pool[rng.integers(0, 5000, 3000)]) for _ in range(1000)])], ["lang", "text"])
    every = lambda x: np.ones(len(x), bool)
    one = np.ones(phrases.BUCKETS, np.int64)
    for run in (phrases._count_words(0), phrases._count_pairs(0, every), phrases._send_suffixes(0, every, every, one * 0, one)):
        tracemalloc.start()
        try:
            counted, rows = 0, []
            for found in run(iter([batch])):
                counted += int(np.sum(found.column("n").to_numpy()))
                rows.append(found.num_rows)
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert counted in (3_000_000, 2_999_000)  # words, and words with a successor
        assert max(rows) <= 1 << 16 and peak < 150 << 20

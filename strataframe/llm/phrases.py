"""Phrase mining over whole corpora: counts of all phrases of 2 to 5 words that occur often, by vertical
partitioning of a truncated suffix tree.

1. Words are counted exactly. Only frequent words can be part of a frequent phrase.
2. Two-word prefixes are counted by a 64-bit hash. A prefix below the support is never built; prefixes are
   put into groups of at most ``budget`` occurrences. A prefix that is over the budget by itself is
   lengthened to whole truncated suffixes, which are spread over groups of their own.
3. Each task sends the distinct truncated suffixes of its texts, with their counts, to their groups. A group is
   one sorted table of suffixes: its common prefixes are the nodes of the subtree, and a node's count is the
   total of the leaves below it. Where a prefix is spread over groups, its nodes' counts are added up after.
4. Phrases are scored by their weakest cut with decimal arithmetic.

Words are named by 64-bit hashes of language and word. Two words of one hash are found by step 1, and then
another seed is taken, so counts are exact. Filters are bitmaps of a bounded size; what they let through by
mistake only costs time. Tables between the steps are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strataframe.llm.common import mix64, run_hashes, text_steps, token_runs, written

#: Longest phrase, in words.
DEPTH = 5
#: Bytes of text of one vectorised step (a step needs about 50 times as much memory), rows passed on at once,
#: suffix occurrences of one group, buckets of prefixes.
STEP_BYTES, OUT_ROWS, GROUP_SUFFIXES, BUCKETS = 2 << 20, 1 << 16, 1 << 17, 1 << 12
#: Bits of a filter: so many for each entry, in a bitmap of at most 16 MB, made of blocks.
BITS_EACH, MOST_BITS, BLOCK_BITS = 16, 1 << 27, 1 << 15
UNKNOWN_LANGUAGE = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: Classes of bytes: 0 between words, 1 in words, 2 between pieces.
_CLASS = np.ones(256, np.uint8)
_CLASS[[0x20, 0x09]] = 0
_CLASS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _tokens(batch: pa.RecordBatch, seed: int):
    """For each step of a batch of (lang, text): lower-cased bytes, word starts and ends, row of each word, names,
    whether the word and the one before it are in one piece."""
    for a, b, raw, offsets in text_steps(batch.column("text"), STEP_BYTES):
        raw = _LOWER[raw]
        start, end, row, kind = token_runs(raw, offsets, _CLASS)
        word = kind == 1
        piece = np.cumsum(~word)[word]
        start, end, row = start[word], end[word], row[word]
        langs = batch.column("lang").slice(a, b - a).dictionary_encode()
        texts = pa.array([x for x in langs.dictionary.to_pylist()] or [""], pa.large_string())
        flat = np.concatenate([np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8), np.zeros(8, np.uint8)])
        sizes = np.array([len(x.encode()) for x in texts.to_pylist()], np.int64)
        tongue = run_hashes(flat, np.cumsum(sizes) - sizes, sizes, seed + 1)[langs.indices.to_numpy(zero_copy_only=False)]
        name = mix64(run_hashes(raw, start, end - start, seed) ^ (tongue[row] * _ODD))
        name[name == 0] = 1  # 0: no word
        linked = np.zeros(len(start), bool)
        linked[1:] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
        yield a, raw, start, end, row, name, linked


def _substrings(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    ends = np.cumsum(size)
    flat = raw[np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes()))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _passed_on(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of a step in batches that need little memory where they arrive."""
    batch = pa.RecordBatch.from_arrays(columns, names)
    for at in range(0, batch.num_rows, OUT_ROWS):
        yield batch.slice(at, OUT_ROWS)


def _count_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, raw, start, end, row, name, _ in _tokens(batch, seed):
                names, first, n = np.unique(name, return_index=True, return_counts=True)
                yield from _passed_on(
                    [_longs(names), batch.column("lang").take(pa.array(a + row[first])).cast(pa.string()),
                     _substrings(raw, start[first], end[first]).cast(pa.string()), pa.array(n.astype(np.int64))], ["name", "lang", "word", "n"])

    return run


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def word_counts(texts: DataFrame, most_seeds: int = 8) -> tuple[DataFrame, int]:
    """(name, lang, word, n) of every distinct word of (lang, text), written, and the seed of the names."""
    for seed in range(most_seeds):
        parts = texts.mapInArrow(_count_words(seed), "name long, lang string, word string, n long").repartition("name")
        spelt = F.struct("lang", "word")
        table = written(parts.groupBy("name").agg(F.min(spelt).alias("word"), F.max(spelt).alias("other"), F.sum("n").alias("n")), "words")
        if not table.where(F.col("word") != F.col("other")).take(1):
            return table.select("name", "word.lang", "word.word", "n"), seed
    raise RuntimeError("words of equal hashes under every seed")


class Filter:
    """A bitmap of 64-bit numbers: tells those that were never added, but for a few."""

    def __init__(self, numbers: DataFrame, column: str):
        n = numbers.count()
        self.bits = min(MOST_BITS, max(BLOCK_BITS, 1 << max(0, n * BITS_EACH - 1).bit_length()))
        shift, mask = self.bits.bit_length() - 1, BLOCK_BITS - 1
        place = F.shiftrightunsigned(F.col(column), 64 - shift)

        def block(table: pa.Table) -> pa.Table:
            flags = np.zeros(BLOCK_BITS, bool)
            flags[table["place"].to_numpy() & mask] = True
            return pa.table([table["block"].slice(0, 1), pa.array([np.packbits(flags).tobytes()], pa.binary())], ["block", "flags"])

        blocks = numbers.select(place.alias("place"), (place / BLOCK_BITS).cast("long").alias("block")).distinct()
        blocks = blocks.groupBy("block").applyInArrow(block, "block long, flags binary").toArrow()
        self.flags = np.zeros(self.bits // 8, np.uint8)
        for at, flags in zip(blocks["block"].to_pylist(), blocks["flags"].to_pylist(), strict=True):
            self.flags[at * (BLOCK_BITS // 8):(at + 1) * (BLOCK_BITS // 8)] = np.frombuffer(flags, np.uint8)

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        place = numbers >> np.uint64(64 - (self.bits.bit_length() - 1))
        return (self.flags[(place >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8))) & 1 > 0


def _pairs(name: np.ndarray, linked: np.ndarray, frequent: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with its successor, and whether both are frequent and of one piece."""
    pair, good = np.zeros(len(name), np.uint64), np.zeros(len(name), bool)
    known = frequent(name)
    good[:-1] = linked[1:] & known[:-1] & known[1:]
    pair[:-1] = mix64(name[:-1] * _ODD + name[1:])
    return pair, good


def _count_pairs(seed: int, frequent: Filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, _, _, name, linked in _tokens(batch, seed):
                pair, good = _pairs(name, linked, frequent)
                pairs, n = np.unique(pair[good], return_counts=True)
                yield from _passed_on([_longs(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])

    return run


def prefix_groups(totals: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """First group of each bucket of prefixes, and the number of groups over which it is spread.
    Neighbouring buckets share a group as long as they fit into the budget together."""
    first, parts = np.zeros(len(totals), np.int64), np.ones(len(totals), np.int64)
    group, room = 0, budget
    for i, total in enumerate(totals.tolist()):
        if total > budget:
            parts[i] = -(-total // budget)
            group += room < budget
            first[i], group, room = group, group + int(parts[i]), budget
            continue
        if total > room:
            group, room = group + 1, budget
        first[i], room = group, room - total
    return first, parts


_SUFFIX = ", ".join(f"w{i} long" for i in range(DEPTH))


def _send_suffixes(seed: int, frequent: Filter, prefixes: Filter, first: np.ndarray, parts: np.ndarray):
    """Distinct truncated suffixes of each step with their counts and groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, _, _, name, linked in _tokens(batch, seed):
                pair, good = _pairs(name, linked, frequent)
                good[good] = prefixes(pair[good])
                chain, words = good.copy(), [name, *(np.zeros(len(name), np.uint64) for _ in range(DEPTH - 1))]
                whole = name.copy()
                for depth in range(1, DEPTH):
                    left = max(0, len(name) - depth)
                    at = np.flatnonzero(chain[:left])
                    words[depth][at] = name[at + depth]
                    whole[at] = mix64(whole[at] * _ODD + name[at + depth])
                    chain = chain.copy()
                    chain[:left] &= good[depth:]
                    chain[left:] = False
                rows = np.flatnonzero(good)
                rows = rows[np.argsort(whole[rows], kind="stable")]
                new = np.zeros(len(rows), bool)
                new[:1] = True
                for column in words:
                    new[1:] |= column[rows][1:] != column[rows][:-1]
                lead = np.flatnonzero(new)
                n = np.diff(np.append(lead, len(rows)))
                rows = rows[lead]
                bucket = (pair[rows] & np.uint64(BUCKETS - 1)).astype(np.int64)
                group = first[bucket] + ((whole[rows] >> np.uint64(16)) % parts[bucket].astype(np.uint64)).astype(np.int64)
                yield from _passed_on(
                    [pa.array(group), pa.array(parts[bucket] == 1), *(_longs(column[rows]) for column in words), pa.array(n.astype(np.int64))],
                    ["group", "complete", *(f"w{i}" for i in range(DEPTH)), "n"])

    return run


def _subtrees(least: int):
    """Nodes of two words and more of a group's subtrees, with the totals of their leaves."""

    def run(table: pa.Table) -> pa.Table:
        words = np.stack([table[f"w{i}"].to_numpy() for i in range(DEPTH)], 1).view(np.uint64).reshape(-1, DEPTH)
        order = np.lexsort(words.T[::-1])
        words, n, complete = words[order], table["n"].to_numpy()[order], table["complete"].to_numpy(zero_copy_only=False)[order]
        border = np.ones(len(words), bool)
        border[1:] = words[1:, 0] != words[:-1, 0]
        phrases, sizes, counts = [], [], []
        for depth in range(2, DEPTH + 1):
            border[1:] |= words[1:, depth - 1] != words[:-1, depth - 1]
            node = np.flatnonzero(border)
            total = np.add.reduceat(n, node)
            use = (words[node, depth - 1] != 0) & ((total >= least) | ~complete[node])
            phrases.append(words[node[use], :depth].ravel())
            sizes.append(np.full(int(use.sum()), depth, np.int64))
            counts.append(total[use])
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        return pa.table([pa.ListArray.from_arrays(pa.array(ends), _longs(np.concatenate(phrases))), pa.array(np.concatenate(counts))], ["phrase", "a"])

    return run


def frequent_phrases(texts: DataFrame, words: DataFrame, seed: int, least: int, budget: int = GROUP_SUFFIXES) -> DataFrame:
    """(phrase, a): every phrase of 2 to 5 words that occurs ``least`` times, as the array of its words' names."""
    frequent = Filter(words.where(F.col("n") >= least), "name")
    pairs = texts.mapInArrow(_count_pairs(seed, frequent), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = written(pairs.where(F.col("n") >= least), "prefixes")
    prefixes = Filter(pairs, "pair")
    totals = np.zeros(BUCKETS, np.int64)
    for bucket, n in pairs.groupBy(F.col("pair").bitwiseAND(BUCKETS - 1).alias("bucket")).agg(F.sum("n")).collect():  # BUCKETS rows at most
        totals[bucket] = n
    first, parts = prefix_groups(totals, budget)
    sent = texts.mapInArrow(_send_suffixes(seed, frequent, prefixes, first, parts), f"group long, complete boolean, {_SUFFIX}, n long")
    nodes = sent.groupBy("group").applyInArrow(_subtrees(least), "phrase array<long>, a long")
    return written(nodes.groupBy("phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least), "phrases")


def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, cover_percent: int = 100, text_col: str = "text",
                 lang_col: str = "lang", budget: int = GROUP_SUFFIXES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by the score of their weakest cut.

    A phrase of 2 to 5 words inside a piece is a candidate if it occurs ``least`` times. Cut after k words it has
    l = f(first part), r = f(rest) and score floor(1000 a n / (l r)); the lowest score counts, then the smallest
    k. Candidates inside a longer one that occurs ``cover_percent`` of their times are dropped. Order: score, a (descending), phrase.

    A null text is empty; a null language is ``und``; every row counts, also rows that repeat; no words give no
    rows. Columns of other names are not read.
    """
    texts = _texts(docs, text_col, lang_col)
    words, seed = word_counts(texts)
    phrases = frequent_phrases(texts, words, seed, least, budget)
    return scored(phrases, words, least, top, cover_percent)


def scored(phrases: DataFrame, words: DataFrame, least: int, top: int, cover_percent: int) -> DataFrame:
    """The result of ``collocations`` from (phrase, a) and (name, lang, word, n)."""
    frequent = words.where(F.col("n") >= least)
    counts = phrases.unionByName(frequent.select(F.array("name").alias("phrase"), F.col("n").alias("a")))
    cut = phrases.select("phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cut = cut.withColumn("head", F.slice("phrase", F.lit(1), F.col("k"))).withColumn("rest", F.slice("phrase", F.col("k") + 1, F.size("phrase") - F.col("k")))
    cut = cut.join(counts.select(F.col("phrase").alias("head"), F.col("a").alias("l")), "head")
    cut = cut.join(counts.select(F.col("phrase").alias("rest"), F.col("a").alias("r")), "rest")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    tongues = F.broadcast(totals) if totals.count() <= 10_000 else totals  # a size that was counted
    lead = frequent.select(F.col("name").alias("first"), "lang").join(tongues, "lang")
    cuts = cut.withColumn("first", F.col("phrase")[0]).join(lead, "first")
    score = F.expr("(cast(1000 as decimal(4,0)) * (cast(a as decimal(17,0)) * cast(total as decimal(17,0)))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    weakest = cuts.withColumn("score", score).groupBy("phrase").agg(
        F.min_by(F.struct("lang", "a", "l", "r", F.col("total").alias("n"), "score"), F.struct("score", "k")).alias("cut"))
    inside = phrases.where(F.size("phrase") > 2).select(
        F.col("a").alias("longer"), "phrase", F.explode(F.sequence(F.lit(2), F.size("phrase") - 1)).alias("size"))
    inside = inside.select("longer", "phrase", "size", F.explode(F.sequence(F.lit(1), F.size("phrase") - F.col("size") + 1)).alias("at"))
    inside = inside.groupBy(F.slice("phrase", F.col("at"), F.col("size")).alias("phrase")).agg(F.max("longer").alias("longer"))
    kept = weakest.join(inside, "phrase", "left").where(F.col("longer").isNull() | (_wide("longer") * 100 < _wide("cut.a") * cover_percent))
    spelt = kept.select("phrase", F.posexplode("phrase").alias("at", "name")).join(frequent.select("name", "word"), "name")
    spelt = spelt.groupBy("phrase").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("text"))
    named = kept.join(spelt, "phrase").select("cut.*", F.col("text").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

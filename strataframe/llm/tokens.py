"""Token ids of whole texts, and their binary output.

``write_tokens`` encodes documents in ascending id order and writes Parquet files with one list of
ids per document: dictionary-encoded ids (delta-encoded where a dictionary gets too large), small
pages with page indexes, row groups of a chosen size. ``read_tokens`` reads any selection back.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.llm.common import chunks, run_hashes, shared_path, text_steps, token_runs, words_at

END_ID = 2
#: Words that a worker keeps with their ids; beyond that it forgets all of them and starts again.
KEEP_WORDS, SLOT_BITS = 1_500_000, 22
#: Bytes of text of one vectorised step.
STEP_BYTES = 2 << 20
ROW_GROUP_BYTES, PAGE_BYTES = 32 << 20, 1 << 20

_ENCODERS: dict[str, WordEncoder] = {}
_WORD = np.ones(256, np.uint8)
_WORD[[9, 10, 11, 12, 13, 32]] = 0
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class WordTable:
    """Known words by a 64-bit hash: where their ids lie in a pool. A second key of length and first
    bytes is compared too."""

    def __init__(self, keep: int, slot_bits: int):
        self.keep, self.shift, self.mask = keep, np.uint64(64 - slot_bits), (1 << slot_bits) - 1
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(self.mask + 1, -1, np.int32)
        self.n, self.used = 0, 0
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def find(self, key: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for unknown ones."""
        out = np.full(len(key), -1)
        todo = np.arange(len(key))
        slot = (key >> self.shift).astype(np.int64)
        while len(todo):
            got = self.slots[slot]
            some = got >= 0
            same = some.copy()
            same[some] = self.key[got[some]] == key[todo[some]]
            out[todo[same]] = got[same]
            on = some & ~same
            todo, slot = todo[on], (slot[on] + 1) & self.mask
        return out

    def add(self, key: np.ndarray, check: np.ndarray, size: np.ndarray, pool: np.ndarray) -> None:
        """Words that are not known yet, of distinct keys."""
        number = np.arange(self.n, self.n + len(key), dtype=np.int32)

        def room(old: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
            if used + len(new) > len(old):
                old = np.concatenate([old[:used], np.zeros(max(len(new), used) + 1024, old.dtype)])
            old[used:used + len(new)] = new
            return old

        self.at = room(self.at, self.n, self.used + np.cumsum(size, dtype=np.int64) - size)
        self.size, self.key, self.check = room(self.size, self.n, size), room(self.key, self.n, key), room(self.check, self.n, check)
        self.pool = room(self.pool, self.used, pool)
        self.n, self.used = self.n + len(key), self.used + len(pool)
        slot = (key >> self.shift).astype(np.int64)
        while len(number):
            free = np.flatnonzero(self.slots[slot] < 0)
            self.slots[slot[free]] = number[free]  # of several words for a slot the last one gets it
            on = self.slots[slot] != number
            number, slot = number[on], (slot[on] + 1) & self.mask


class WordEncoder:
    """Encodes texts with a tokenizer file whose pre-tokens never span ASCII white space.

    Such a text's ids are those of its white-space words, one after the other, so each distinct
    word is encoded once and its ids are looked up from then on. An ASCII word is looked up in lower
    case where the tokenizer ignores case, unless that spells an added token, which is matched as it stands; a comma or full stop behind an ASCII letter at the end of a
    word is a pre-token of its own. Other tokenizers encode whole texts.
    """

    def __init__(self, path: str, keep: int = KEEP_WORDS, slot_bits: int = SLOT_BITS):
        from tokenizers import Tokenizer

        self.tokenizer, self.table = Tokenizer.from_file(path), WordTable(keep, slot_bits)
        probe = ["Ab ab\tcd\n ef.. gh, 12\x0b'll\x0c", "X. Y, Z'S,", "THE wORD"]
        whole = self._encode(probe)
        parts = [self._encode([x for w in t.split() for x in ((w[:-1], w[-1]) if w[-1] in ".," and w[-2].isalpha() else (w,))]) for t in probe]
        self.split = whole == [[i for part in found for i in part] for found in parts]
        self.lower = whole == self._encode([t.lower() for t in probe])
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # contents of added tokens, which a text holds in any case
        self.added = re.compile(b"|".join(re.escape(x) for x in added), re.I) if added else None
        # lower-case ASCII letters alone: one pre-token as they stand, which the model takes directly
        normal, cut, letters = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, "abcdefghijklmnopqrstuvwxyz"
        self.direct = (normal is None or normal.normalize_str(letters) == letters) and (
            cut is not None and [x for x, _ in cut.pre_tokenize_str(letters)] == [letters])

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray, check: np.ndarray) -> None:
        data = raw.tobytes()
        words = [data[a:b].decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        found = [None] * len(words)
        if self.direct:
            cut = self.tokenizer.model.tokenize
            found = [[t.id for t in cut(w)] if w.isascii() and w.isalpha() and w.islower() else None for w in words]
        other = [k for k, ids in enumerate(found) if ids is None]
        for k in range(0, len(other), 20_000):
            part = other[k:k + 20_000]
            for place, ids in zip(part, self._encode([words[i] for i in part]), strict=True):
                found[place] = ids
        size = np.fromiter(map(len, found), np.int32, len(found))
        self.table.add(key, check, size, np.fromiter(chain.from_iterable(found), np.int32, int(size.sum())))

    def _step(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        start, end, text, _ = token_runs(raw, offsets, _WORD)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        if self.lower:
            wide = np.maximum.reduceat(raw, start) >= 128  # not ASCII alone, or with the letters of an added token
            if self.added is not None:
                held = np.fromiter((m.start() for m in self.added.finditer(raw)), np.int64)
                wide[np.searchsorted(start, held, "right") - 1] = True
            low = _LOWER[raw]
            size = (end - start)[wide]
            index = np.arange(int(size.sum())) + np.repeat(start[wide] - (np.cumsum(size) - size), size)
            low[index] = raw[index]
            raw = low
        last = raw[end - 1]
        tail = ((last == 44) | (last == 46)) & (end - start > 1) & _LETTER[raw[end - 2]]
        place = np.arange(len(start)) + np.cumsum(tail) - tail
        total = len(start) + int(tail.sum())
        starts, ends, texts = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int64)
        starts[place], ends[place], texts[place] = start, end - tail, text
        behind = place[tail] + 1
        starts[behind], ends[behind], texts[behind] = end[tail] - 1, end[tail], text[tail]
        size = ends - starts
        key = run_hashes(raw, starts, size)
        check = words_at(raw)[starts]
        short = np.minimum(size, 8).astype(np.uint64) * np.uint64(8)
        check = np.where(size < 8, check & ((np.uint64(1) << (short % np.uint64(64))) - np.uint64(1)), check) ^ (size.astype(np.uint64) << np.uint64(40))
        table = self.table
        number = table.find(key)
        new = np.flatnonzero(number < 0)
        if len(new):
            distinct, first = np.unique(key[new], return_index=True)
            if table.n + len(distinct) > table.keep:
                table.clear()
                distinct, first = np.unique(key, return_index=True)
                new = np.arange(len(key))
            # a step of more distinct words than the table has room for is taken in parts
            if len(distinct) > table.keep:
                raise _TooMany
            at = new[first]
            self._learn(raw, starts[at], ends[at], distinct, check[at])
            number[new] = table.find(key[new])
        odd = np.flatnonzero(table.check[number] != check)
        sizes = table.size[number].astype(np.int64)
        if len(odd):  # two words of one hash: texts that hold the second one are encoded as they are
            raise _Clash(np.unique(texts[odd]))
        begin = np.cumsum(sizes) - sizes
        ids = table.pool[np.arange(int(sizes.sum())) + np.repeat(table.at[number] - begin, sizes)]
        return ids, np.bincount(texts, sizes, len(offsets) - 1).astype(np.int64)

    def encode(self, raw: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids) of texts as ``flat_text`` gives them, each followed by ``end``."""
        found, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        todo = list(chunks(offsets, STEP_BYTES))[::-1]
        while todo:
            a, b = todo.pop()
            part = np.concatenate([raw[offsets[a]:offsets[b]], np.zeros(8, np.uint8)])
            own = offsets[a:b + 1] - offsets[a]
            try:
                if not self.split:
                    raise _Clash
                ids, n = self._step(part, own)
            except (_TooMany, _Clash):
                if b - a > 1:
                    todo += [((a + b) // 2, b), (a, (a + b) // 2)]
                    continue
                ids = np.array(self._encode([part[:-8].tobytes().decode()])[0], np.int32)
                n = np.array([len(ids)])
            found.append(ids), counts.append(n)
        ids, counts = np.concatenate(found), np.concatenate(counts)
        if end is None:
            return ids, np.append(0, np.cumsum(counts))
        out = np.full(len(ids) + len(counts), end, np.int32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
        return out, np.append(0, np.cumsum(counts + 1))


class _TooMany(Exception):
    """More distinct words in a step than the table may keep."""


class _Clash(Exception):
    """Words that can't be told apart, or a tokenizer that doesn't work by words."""


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, partitions: int | None = None) -> None:
    """Write (id, shard, place, start_in_shard, n_tokens, ids) to Parquet files below ``path``.

    Documents are in ascending id order (null ids first, equal ids by text): shard by shard, and
    within a shard by place. Null and empty texts are the end id alone.
    """
    spark = docs.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # texts are ordered before they are encoded: a range shuffle looks twice at what it orders
    ordered = rows.repartitionByRange(parts, "id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    id_type = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = place = 0
        for batch in batches:
            for a, b, part, own in text_steps(batch.column(1), STEP_BYTES):
                flat, at = encoder(tokenizer).encode(part, own, end_id)
                ids = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(place + np.arange(b - a)), pa.array(start + at[:-1]), pa.array(np.diff(at)), ids],
                    ["id", "shard", "place", "start_in_shard", "n_tokens", "ids"])
                start, place = start + len(flat), place + b - a

    encoded = ordered.withColumn("shard", F.spark_partition_id()).mapInArrow(
        encode, f"id {id_type}, shard int, place long, start_in_shard long, n_tokens long, ids array<int>")
    (encoded.write.option("parquet.enable.dictionary", "true").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.dictionary.page.size", PAGE_BYTES).parquet(path))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens[, ids]) of files that ``write_tokens`` wrote: start counts the ids of all
    documents before. Without ids only the narrow columns are read."""
    rows = spark.read.parquet(path)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # one row per shard
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = totals.select(F.col("shard").alias("s"), F.coalesce(before, F.lit(0).cast("long")).alias("before"))
    joined = rows.join(F.broadcast(shards), F.col("shard") == F.col("s"))  # as many rows as files
    return joined.select("id", (F.col("before") + F.col("start_in_shard")).alias("start"), "n_tokens",
                         *(["ids"] if with_ids else []))


def id_checksums(tokens: DataFrame, ids_col: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """``tokens`` with the unsigned crc32 of the ids as little-endian 32-bit integers in place of them."""
    rest = [c for c in tokens.columns if c != ids_col]
    fields = ", ".join(f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in rest)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(rest))
            offsets = lists.offsets.to_numpy()
            flat = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            sums = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], [*rest, out])

    return tokens.select(*rest, ids_col).mapInArrow(check, f"{fields}, {out} long")


def token_table(docs: DataFrame, tokenizer: str, label: str = "tokens", **params) -> DataFrame:
    """``docs`` written by ``write_tokens`` to the shared folder and read back."""
    path = shared_path(docs.sparkSession, label)
    write_tokens(docs, path, tokenizer, **params)
    return read_tokens(docs.sparkSession, path)

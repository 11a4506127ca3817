"""Exact removal of long repeated byte strings, by suffix arrays in shards.

1. *Blocks and keys.* Documents are dealt into blocks by a hash. A string of ``length`` bytes holds
   length - GRAM + 1 grams of GRAM bytes; the least hash among them is the key of the string, so
   equal strings have equal keys. Neighbouring starts mostly share a key; such a run of starts is
   one segment of text. Blocks send the keys they hold to shards, and shards answer which of them
   more than one document holds.
2. *Suffix array.* Blocks send the segments of such keys to shards: once, whichever of the block's
   documents hold it, as only the smallest document matters to others. A shard joins its segments and
   sorts their suffixes in two stages: suffixes smaller than their successors are sorted directly;
   all others are induced from them in one scan over the buckets of first bytes.
3. *Common prefixes.* Neighbours in the array with a common prefix of ``length`` bytes form a
   class; a start is repeated if its class holds a smaller document. The ranges return to the blocks.

Blocks and shards grow with the input, so a message for every pair of them would be a number of messages that
grows with its square. Beyond ``DIRECT`` shards messages go by relays: a relay serves about the root of the number
of shards. It gets one message of each of as many blocks, merges their contents and sends one message to each of its
shards; answers and ranges come back the same way. A block then writes about the root of the number of shards.

A key with very many segments (a frequent gram in many contexts) is split by the shards' answer: its
strings are routed one by one, by a hash of all their bytes. Keys and routes decide nothing; any
choice gives the same result. The texts are shuffled once: all three steps that need them read the
same exchange.

What a task holds follows from the bytes of a block or shard, which are bounded whatever the number of partitions. A
shard's keys decide nothing about each other, so their suffix arrays are made for some megabytes of segments at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.llm.common import chunks, flat_text, give_back, mix64, run_hashes, sliding_min, words_at

LENGTH = 50
#: Bytes of the grams whose least hash is a key, and bits of a key by which shards count its documents
#: (more documents than thought only mean more text sent).
GRAM, COUNT_BITS = 16, 48
#: Bytes of one vectorised step.
STEP_BYTES = 256 << 10
#: Bytes of text at most, on average, of a partition, of a block and for each shard, whatever the session's number of
#: partitions (a shard's segments overlap: they have up to four times as many bytes).
PART_BYTES, BLOCK_BYTES, SHARD_BYTES = 128 << 20, 12 << 20, 18 << 20
#: Bytes of segments of one suffix array, where a key has not more.
ARRAY_BYTES = 4 << 20
#: Segments of a key from which on its strings are routed one by one.
SPLIT = 65_536
#: Shards up to which blocks write to them without relays (some tens of kilobytes a message at PART_BYTES).
DIRECT = 1_024
END = 0xFF  # in no UTF-8 text


# ------------------------------------------------------------------ suffix array of a shard
def ascending(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor (the last suffix is not)."""
    last = np.flatnonzero(np.append(text[1:] != text[:-1], True))  # last place of each run of a byte
    up = np.zeros(len(last), bool)
    up[:-1] = text[last[:-1] + 1] > text[last[:-1]]
    return np.repeat(up, np.diff(last, prepend=-1))


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted suffixes (a mask) in order of their first ``depth`` bytes, by two-stage sorting.

    A wanted suffix that is larger than its successor needs the successor wanted too; ``text``
    must go on for ``depth`` bytes behind the last wanted one.
    """
    small = ascending(text)
    direct = np.flatnonzero(wanted & small)
    windows = np.lib.stride_tricks.sliding_window_view(text, depth)
    direct = direct[np.argsort(np.ascontiguousarray(windows[direct]).view(f"S{depth}").ravel(), kind="stable")]
    induce = wanted & ~small
    cuts = np.searchsorted(text[direct], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for byte in range(256):
        bucket, level = [], np.concatenate(pending[byte]) if pending[byte] else np.zeros(0, np.int64)
        pending[byte] = []
        while len(level):  # suffixes whose successor is in this bucket follow those of smaller successors
            bucket.append(level)
            level = level[level > 0] - 1
            level = level[induce[level] & (text[level] == byte)]
        bucket.append(direct[cuts[byte]:cuts[byte + 1]])
        bucket = np.concatenate(bucket)
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induce[before] & (text[before] > byte)]
        first = text[before]
        for b in np.unique(first).tolist():
            pending[b].append(before[first == b])
    return np.concatenate(order) if order else np.zeros(0, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it, at most ``depth``."""
    windows = np.lib.stride_tricks.sliding_window_view(text, depth)
    out = np.zeros(len(order), np.int64)
    for k in range(1, len(order), 1 << 16):
        at = order[k - 1:k + (1 << 16)]
        rows = windows[at]
        differ = rows[1:] != rows[:-1]
        out[k:k + len(at) - 1] = np.where(differ.any(1), differ.argmax(1), depth)
    return out


def least_holders(text: np.ndarray, begin: np.ndarray, run: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """The smallest document that holds each string, for the ``run`` strings of each segment in turn.

    Segment i starts at begin[i] of ``text``, ends with END, and is held by document least[i] at
    the smallest.
    """
    starts = np.zeros(len(text) + 1, np.int8)  # segments are apart, so sums are 0 or 1
    np.add.at(starts, begin, 1)
    np.add.at(starts, begin + run, -1)
    is_start = np.cumsum(starts[:-1], dtype=np.int8) > 0
    # each start's chain of descending successors ends at an ascending suffix
    small = ascending(text)
    wanted = is_start.copy()
    edge = begin + run
    edge = edge[~small[edge - 1]]
    while len(edge):
        wanted[edge] = True
        edge = edge[~small[edge]] + 1
        edge = edge[edge < len(text)]
    padded = np.concatenate([text, np.full(length, END, np.uint8)])
    order = suffix_order(padded, np.concatenate([wanted, np.zeros(length, bool)]), length)
    order = order[is_start[order]]
    apart = common_prefixes(padded, order, length) < length
    if len(apart):
        apart[0] = True
    holder = np.zeros(len(text), least.dtype)
    holder[is_start] = np.repeat(least, run)
    firsts = np.flatnonzero(apart)
    of_class = np.minimum.reduceat(holder[order], firsts) if len(firsts) else least[:0]
    holder[order] = np.repeat(of_class, np.diff(np.append(firsts, len(order))))
    return holder[is_start]


# ------------------------------------------------------------------ segments
def gather(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """raw[begin[i] : begin[i] + size[i]] of all i, joined."""
    ends = np.cumsum(size)
    index = np.repeat(begin - (ends - size), size)
    index += np.arange(len(index))
    return raw[index]


def segments(raw: np.ndarray, offsets: np.ndarray, length: int):
    """(key, begin, run) of the segments of the rows in ``raw``: strings begin..begin+run-1 share ``key``."""
    n = int(offsets[-1])
    gram = min(GRAM, length)
    if n < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    view = words_at(raw)
    h = np.zeros(n - gram + 1, np.uint64)
    for k in range(0, gram, 8):
        part = view[k:k + len(h)]
        if gram - k < 8:
            part = part & np.uint64((1 << 8 * (gram - k)) - 1)
        h = (h ^ part) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    least = sliding_min(mix64(h), length - gram + 1)
    inside = np.zeros(n + 1, np.int64)  # starts with `length` bytes of their row left
    sizes = np.diff(offsets)
    long_rows = sizes >= length
    np.add.at(inside, offsets[:-1][long_rows], 1)
    np.add.at(inside, offsets[1:][long_rows] - length + 1, -1)
    inside = np.cumsum(inside)[:len(least)] > 0
    change = np.empty(len(least) + 1, bool)
    change[0] = change[-1] = True
    change[1:-1] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
    change[offsets[offsets < len(least)]] = True
    at = np.flatnonzero(change)
    begin, run = at[:-1], np.diff(at)
    use = inside[begin]
    return least[begin[use]], begin[use], run[use]


_PRESS, _OPEN = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Integer arrays as compressed bytes behind their lengths; each goes by planes of bytes, which compress better."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], "<i8").tobytes()
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    return head + _PRESS.compress(b"".join(planes))


def _lengths(blob: bytes | pa.Buffer, types: tuple[str, ...]) -> list[int]:
    return np.frombuffer(blob, "<i8", len(types), 8).tolist()


def _blobs(column: pa.ChunkedArray) -> list[pa.Buffer]:
    """The messages of a column, without a copy."""
    return [m.as_buffer() for m in column]


def _unpack(blob: bytes | pa.Buffer, types: tuple[str, ...]) -> list[np.ndarray]:
    raw = _OPEN.decompress(memoryview(blob)[8 * (len(types) + 1):])
    at, out = 0, []
    for t, n in zip(types, _lengths(blob, types), strict=True):
        width = np.dtype(t).itemsize
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n) if width > 1 else planes.reshape(n).view(t))
        at += n * width
    return out


class _Block:
    """The distinct documents with an id of one block, in order, and their segments."""

    def __init__(self, ids: pa.ChunkedArray, hashes: pa.ChunkedArray, texts: pa.ChunkedArray, length: int):
        rows = pa.table({"id": ids, "hash": hashes, "text": texts})
        rows = (rows.filter(pa.compute.is_valid(ids)) if ids.null_count else rows).combine_chunks()
        both = np.empty(rows.num_rows, [("id", "<i8"), ("hash", "<i8")])
        both["id"], both["hash"] = (rows.column(k).to_numpy() for k in range(2))
        both, first = np.unique(both, return_index=True)
        self.ids, self.hashes, self.length = both["id"], both["hash"], length
        text = rows.column("text").take(pa.array(first))
        del rows
        self.raw, self.offsets = flat_text(pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.string()))

    def ordinals(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The places of documents that the block holds."""
        own, asked = (np.rec.fromarrays([i, h], names="id,hash") for i, h in ((self.ids, self.hashes), (ids, hashes)))
        return np.searchsorted(own, asked)

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, begins, runs = [], [], []
        for a, b in chunks(self.offsets, STEP_BYTES):
            raw = np.concatenate([self.raw[self.offsets[a]:self.offsets[b]], np.zeros(8, np.uint8)])
            key, begin, run = segments(raw, self.offsets[a:b + 1] - self.offsets[a], self.length)
            keys.append(key), begins.append(begin + self.offsets[a]), runs.append(run)
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(begins), np.concatenate(runs)

    def docs(self, begin: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, begin, "right") - 1


def _in_turn(number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stable order by ``number``, the distinct numbers, and where each begins in that order (and the end)."""
    order = np.argsort(number, kind="stable")
    ordered = number[order]
    firsts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(order) else order
    return order, ordered[firsts], np.append(firsts, len(order))


def relay_fan(shards: int, direct: int = DIRECT) -> int:
    """Shards that a relay serves; 1 where blocks write to shards themselves. Shards are numbered so that those of
    number // fan have the same relays, and the block or shard that a message comes from chooses among these."""
    return 1 if shards <= direct else math.isqrt(shards - 1) + 1


def _shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    return (key % np.uint64(shards)).astype(np.int64)


def _counted(key: np.ndarray, shards: int, fan: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order of (group of ``fan`` shards, key), each key's place among them, the groups and their cuts."""
    short = key >> np.uint64(64 - COUNT_BITS)
    distinct, place = np.unique(short, return_inverse=True)
    order, groups, cuts = _in_turn(_shard_of(distinct, shards) // fan)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return distinct[order], rank[place], groups, cuts


def _messages(block: int, blobs: dict[int, bytes], name: str) -> pa.Table:
    return pa.table({"block": pa.array(np.full(len(blobs), block)), "shard": pa.array(list(blobs), pa.int64()), name: pa.array(list(blobs.values()), pa.binary())})


def _key_messages(groups: np.ndarray, cuts: np.ndarray, keys: np.ndarray, count: np.ndarray, more: np.ndarray) -> dict[int, bytes]:
    """A message for each group of the ordered keys: the keys as steps, their segments, whether several documents hold them."""
    blobs = {}
    for group, a, b in zip(groups.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        step = np.diff(keys[a:b], prepend=np.uint64(0))
        blobs[group] = _pack([step, np.minimum(count[a:b], 0xFFFFFFFF).astype("<u4"), more[a:b].view(np.uint8)])
    return blobs


def _own(table: pa.Table, length: int) -> _Block:
    return _Block(table["id"], table["hash"], table["text"], length)


def _ask(length: int, shards: int, fan: int = 1) -> Callable:
    """Step 1 in a block: (block, shard or relay, keys): its keys with their segments and whether two documents hold them."""

    def ask(table: pa.Table) -> pa.Table:
        block = _own(table, length)
        key, begin, _ = block.segments()
        distinct, place, groups, cuts = _counted(key, shards, fan)
        ids, n = block.ids[block.docs(begin)], len(distinct)
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        np.minimum.at(low, place, ids)
        np.maximum.at(high, place, ids)
        number = table["block"][0].as_py()
        blobs = _key_messages(groups * fan + number % fan, cuts, distinct, np.bincount(place, minlength=n), low < high)
        give_back()
        return _messages(number, blobs, "keys")

    return ask


def _met(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the key messages of a shard or relay: their sizes, the distinct keys, each sent key's place among them, and of
    each distinct key the segments and the documents that hold it (1, or more). One message after the other is
    unpacked, in arrays of the shard."""
    parts = [_unpack(b.as_py(), ("<u8", "<u4", "u1")) for b in table["keys"]]
    distinct, place = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
    total = np.bincount(place, np.concatenate([p[1] for p in parts]))
    holders = np.bincount(place) + np.bincount(place, np.concatenate([p[2] for p in parts]))
    return [len(p[0]) for p in parts], distinct, place, total, holders


def _codes(table: pa.Table, code: np.ndarray, sizes: list[int]) -> pa.Table:
    codes = [_pack([c]) for c in np.split(code, np.cumsum(sizes)[:-1])]
    return pa.table({"block": table["block"], "shard": table["shard"], "codes": pa.array(codes, pa.binary())})


def _all_codes(answers: pa.Table) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint8), *(_unpack(c.as_py(), ("u1",))[0] for c in answers.sort_by("shard")["codes"])])


def _answer(split: int):
    """Step 1 in a shard: (block, shard, codes): 0 one document holds the key, 1 more do, 2 more do
    and its strings go one by one."""

    def answer(table: pa.Table) -> pa.Table:
        sizes, _, place, total, holders = _met(table)
        return _codes(table, np.where(holders > 1, np.where(total > split, 2, 1), 0).astype(np.uint8)[place], sizes)

    return answer


def _merge_keys(shards: int) -> Callable:
    """Step 1 in a relay: the keys of its blocks as one message for each of its shards."""

    def merge(table: pa.Table) -> pa.Table:
        _, distinct, _, total, holders = _met(table)
        order, groups, cuts = _in_turn(_shard_of(distinct, shards))
        return _messages(table["shard"][0].as_py(), _key_messages(groups, cuts, distinct[order], total[order], holders[order] > 1), "keys")

    return merge


def _hand_back(shards: int) -> Callable:
    """Step 1 in a relay: the shards' answers to its merged messages as answers to its blocks."""

    def hand_back(table: pa.Table, answers: pa.Table) -> pa.Table:
        sizes, distinct, place, _, _ = _met(table)
        code = np.empty(len(distinct), np.uint8)
        code[_in_turn(_shard_of(distinct, shards))[0]] = _all_codes(answers)
        return _codes(table, code[place], sizes)

    return hand_back


#: Of a shard's message: documents' ids, blocks, places in their block | key, run, place in the text, document of each segment | text
_SEGMENTS = ("<i8", "<i4", "<i4", "<u8", "<i4", "<i4", "<i4", "u1")
#: Of a block's message: block, document, first byte, end of repeated ranges.
_RANGES = ("<i4", "<i4", "<i4", "<i4")


def _segment_messages(to: np.ndarray, ids: np.ndarray, of_block: np.ndarray, ordinal: np.ndarray, key: np.ndarray, run: np.ndarray,
                      place: np.ndarray, doc: np.ndarray, text: np.ndarray, begin: np.ndarray, length: int) -> dict[int, bytes]:
    """Messages with the segments that go ``to`` each shard or relay, their documents and bytes (from ``begin`` of ``text``)."""
    order, numbers, cuts = _in_turn(to)
    blobs = {}
    for number, a, b in zip(numbers.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        s = order[a:b]
        used, local = np.unique(doc[s], return_inverse=True)
        columns = [ids[used], of_block[used], ordinal[used], key[s], run[s], place[s], local, gather(text, begin[s], run[s] + length - 1)]
        blobs[number] = _pack([c.astype(t, copy=False) for c, t in zip(columns, _SEGMENTS, strict=True)])
    return blobs


def _joined(blobs: list[pa.Buffer]) -> list[np.ndarray]:
    """Segment messages as one: ids, blocks and places of the documents, then key, run, place, document, text. One message
    after the other is unpacked, in place."""
    ends = np.cumsum([_lengths(m, _SEGMENTS) for m in blobs], axis=0)
    out = [np.empty(n, t) for n, t in zip(ends[-1].tolist(), _SEGMENTS, strict=True)]
    begin = [0] * len(_SEGMENTS)
    for blob, end in zip(blobs, ends.tolist(), strict=True):
        for k, column in enumerate(_unpack(blob, _SEGMENTS)):
            np.add(column, begin[0] if k == 6 else 0, out=out[k][begin[k]:end[k]], casting="same_kind")
        begin = end
    return out


def _join_ranges(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranges with those of a document that touch or overlap joined."""
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    if not len(doc):
        return [x.astype("<i4") for x in (doc, begin, end)]
    lift = doc.astype(np.int64) << 32
    reach = np.maximum.accumulate(lift + end)
    new = np.append(True, (lift + begin)[1:] > reach[:-1])
    return [doc[new].astype("<i4"), begin[new].astype("<i4"), (reach[np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1)] & 0xFFFFFFFF).astype("<i4")]


def _send(length: int, shards: int, fan: int = 1) -> Callable:
    """Step 2 in a block: (block, shard or relay, message) with the segments of keys that more documents hold.
    Equal segments go once, the smallest document's; larger documents' are decided here and pass
    through the shard of the block's number."""

    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _messages(0, {}, "message")
        block = _own(table, length)
        key, begin, run = block.segments()
        code = _all_codes(answers)[_counted(key, shards, fan)[1]]
        single = code == 2
        each = np.repeat(begin[single], run[single]) + np.arange(int(run[single].sum())) - np.repeat(np.cumsum(run[single]) - run[single], run[single])
        key = np.concatenate([key[code == 1], run_hashes(block.raw, each, np.full(len(each), length))])
        begin, run = np.concatenate([begin[code == 1], each]), np.concatenate([run[code == 1], np.ones(len(each), np.int64)])
        doc, size = block.docs(begin), run + length - 1
        same = run_hashes(block.raw, begin, size, 1)
        order = np.lexsort((block.ids[doc], same, key))
        first = np.ones(len(order), bool)
        first[1:] = (key[order][1:] != key[order][:-1]) | (same[order][1:] != same[order][:-1])
        head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        decided = block.ids[doc[order]] > block.ids[doc[head]]
        sent, decided = order[~decided], order[decided]
        place = begin - block.offsets[doc]
        number, n = table["block"][0].as_py(), len(block.ids)
        to = _shard_of(key[sent], shards) // fan * fan + number % fan
        blobs = _segment_messages(to, block.ids, np.full(n, number), np.arange(n), key[sent], run[sent], place[sent], doc[sent],
                                  block.raw, begin[sent], length)
        ranges = _join_ranges(doc[decided], place[decided], place[decided] + size[decided])
        blobs[-1 - number % shards] = _pack([np.full(len(ranges[0]), number, "<i4"), *ranges])
        give_back()
        return _messages(number, blobs, "message")

    return send


def _merge_segments(length: int, shards: int) -> Callable:
    """Step 2 in a relay: the segments of its blocks as one message for each of its shards; blocks' ranges pass."""

    def merge(table: pa.Table) -> pa.Table:
        passing = pa.compute.less(table["shard"], 0)
        out = [table.filter(passing).select(["block", "shard", "message"])]
        table = table.filter(pa.compute.invert(passing))
        if table.num_rows:
            *columns, text = _joined(_blobs(table["message"]))
            size = columns[4] + length - 1
            blobs = _segment_messages(_shard_of(columns[3], shards), *columns, text, np.cumsum(size) - size, length)
            out.append(_messages(table["shard"][0].as_py(), blobs, "message"))
        give_back()
        return pa.concat_tables(out)

    return merge


def _range_messages(to: np.ndarray, columns: list[np.ndarray]) -> list[tuple[int, bytes]]:
    order, numbers, cuts = _in_turn(to)
    columns = [c[order].astype(t, copy=False) for c, t in zip(columns, _RANGES, strict=True)]
    return [(n, _pack([c[a:b] for c in columns])) for n, a, b in zip(numbers.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _sent_ranges(out: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"block": pa.array([b for b, _ in out], pa.int64()), "ranges": pa.array([m for _, m in out], pa.binary())})


def _decide(length: int, fan: int = 1) -> Callable:
    """Steps 2 and 3 in a shard: (block or relay, ranges), the repeated byte ranges of the blocks' documents."""

    def decide(table: pa.Table) -> pa.Table:
        messages, numbers, shards = _blobs(table["message"]), table["block"].to_numpy(), table["shard"].to_numpy()
        own = table["to"][0].as_py() % fan
        out = [(int(b) // fan * fan + own, m.to_pybytes()) for m, b, s in zip(messages, numbers, shards, strict=True) if s < 0]
        messages = [m for m, s in zip(messages, shards, strict=True) if s >= 0]
        if messages:
            ids, of_block, ordinal, *segments_of = _joined(messages)
            doc, begin, end = _join_ranges(*repeated_ranges(ids, *segments_of, length))
            del segments_of
            to = of_block[doc].astype(np.int64) // fan * fan + own
            out += _range_messages(to, [of_block[doc], ordinal[doc], begin, end])
        give_back()
        return _sent_ranges(out)

    return decide


def _merge_ranges(table: pa.Table) -> pa.Table:
    """Step 3 in a relay: the ranges of its blocks as one message for each."""
    parts = [_unpack(m, _RANGES) for m in table["ranges"].to_pylist()]
    columns = [np.concatenate([p[k] for p in parts]) for k in range(4)]
    return _sent_ranges(_range_messages(columns[0].astype(np.int64), columns))


def repeated_ranges(ids: np.ndarray, key: np.ndarray, run: np.ndarray, place: np.ndarray, doc: np.ndarray, text: np.ndarray,
                    length: int, array_bytes: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first byte, end) of ranges that a smaller document repeats, of segments of ``run`` strings
    at ``place`` in document ``doc`` (with id ids[doc]) whose bytes follow each other in ``text``.
    Strings of different keys differ: the keys are taken in turn, of about ``array_bytes`` at a time."""
    size = run + length - 1
    begin = np.cumsum(size) - size
    # keys of one document only can't be repeated from a smaller one
    order = np.argsort(key, kind="stable")
    firsts = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(order) else order
    of = ids[doc[order]]
    lows, highs = (f.reduceat(of, firsts) if len(firsts) else of for f in (np.minimum, np.maximum))
    several = lows < highs
    n_of = np.diff(np.append(firsts, len(order)))
    order = order[np.repeat(several, n_of)]
    rows = np.append(0, np.cumsum(n_of[several]))
    ends = np.append(0, np.cumsum(size[order]))[rows]
    del firsts, of, lows, highs, several, n_of
    give_back()
    found = [(doc[:0], place[:0], place[:0])]
    for a, b in chunks(ends, ARRAY_BYTES if array_bytes is None else array_bytes):
        s = order[rows[a]:rows[b]]
        found.append(_repeated(ids, key[s], run[s], place[s], doc[s], gather(text, begin[s], size[s]), length))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def _repeated(ids: np.ndarray, key: np.ndarray, run: np.ndarray, place: np.ndarray, doc: np.ndarray, text: np.ndarray,
              length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``repeated_ranges`` by one suffix array."""
    size = run + length - 1
    begin = np.cumsum(size) - size
    # equal segments of different blocks: one of them goes into the array
    same = run_hashes(np.concatenate([text, np.zeros(8, np.uint8)]), begin, size)
    order = np.lexsort((ids[doc], same, key))
    same = same[order]
    new = np.ones(len(order), bool)
    new[1:] = (same[1:] != same[:-1]) | (key[order][1:] != key[order][:-1])
    unit = np.cumsum(new) - 1  # of each segment
    heads = order[new]
    least = ids[doc[heads]]
    width = size[heads] + 1
    joined = np.full(int(width.sum()), END, np.uint8)
    at = np.cumsum(width) - width
    where = np.ones(len(joined), bool)
    where[at + width - 1] = False
    joined[where] = gather(text, begin[heads], size[heads])
    holders = least_holders(joined, at, run[heads], least, length)
    # documents above the segment's smallest: all its starts; the smallest itself: starts that others hold
    above = ids[doc[order]] > least[unit]
    whole, rest = order[above], order[~above]
    first = np.cumsum(run[heads]) - run[heads]
    repeated = holders < np.repeat(least, run[heads])
    opens = np.zeros(len(repeated) + 1, bool)  # runs don't cross segments
    opens[first] = opens[-1] = True
    a = np.flatnonzero(repeated & (opens[:-1] | ~np.append(False, repeated)[:-1]))
    b = np.flatnonzero(repeated & (opens[1:] | ~np.append(repeated, False)[1:])) + 1
    owner = np.searchsorted(first, a, "right") - 1
    # a unit's runs belong to each of its smallest document's segments
    n_of = np.bincount(owner, minlength=len(heads))
    begin_of = np.cumsum(n_of) - n_of
    times = n_of[unit[~above]]
    pick = np.arange(int(times.sum())) + np.repeat(begin_of[unit[~above]] - (np.cumsum(times) - times), times)
    rest = np.repeat(rest, times)
    inner = place[rest] + a[pick] - first[owner[pick]]
    return (np.concatenate([doc[whole], doc[rest]]), np.concatenate([place[whole], inner]),
            np.concatenate([place[whole] + size[whole], inner + (b - a)[pick] + length - 1]))


def layout(docs: DataFrame, text_col: str) -> tuple[int, int, int]:
    """The numbers of partitions, blocks and shards. Partitions: the session's number for shuffles, or more where these
    would hold over PART_BYTES of text each. Each has as many blocks and shards as their bytes ask for."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    return parts, *(parts * max(1, -(-size // (parts * most))) for most in (BLOCK_BYTES, SHARD_BYTES))


def partitions(docs: DataFrame, text_col: str) -> int:
    return layout(docs, text_col)[0]


def _dealt(docs: DataFrame, id_col: str, text_col: str, parts: int, blocks: int) -> DataFrame:
    """(block, id, hash, text, row) of ``docs``, dealt into blocks: the one shuffle of the texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    return _placed(rows.withColumn("block", F.pmod(F.xxhash64("id", "hash"), F.lit(blocks))), "block", parts)


def _placed(table: DataFrame, number: str, parts: int) -> DataFrame:
    """``table`` with ``part``, the partition of its block or shard: numbers are dealt out in turn, so
    partitions hold the same count of them, and groups by (part, number) need no other exchange."""
    return table.withColumn("part", (F.col(number) % parts).cast("int")).repartitionById(parts, F.col("part"))


def repeated_blocks(rows: DataFrame, parts: int, shards: int, length: int = LENGTH, split: int = SPLIT, direct: int = DIRECT) -> DataFrame:
    """(block, ranges): the repeated byte ranges of rows that ``_dealt`` dealt to ``parts`` partitions."""
    fan = relay_fan(shards, direct)
    keys, codes, message, ranges = ("block long, shard long, keys binary", "block long, shard long, codes binary",
                                    "block long, shard long, message binary", "block long, ranges binary")

    def gathered(table: DataFrame, number: str):
        return _placed(table, number, parts).groupBy("part", number)

    def addressed(table: DataFrame):  # a block's own ranges go through the shard -1 - number
        return gathered(table.withColumn("to", F.when(F.col("shard") < 0, -1 - F.col("shard")).otherwise(F.col("shard"))), "to")

    asked = rows.groupBy("part", "block").applyInArrow(_ask(length, shards, fan), keys)
    if fan == 1:
        answers = gathered(asked, "shard").applyInArrow(_answer(split), codes)
    else:
        merged = gathered(asked, "shard").applyInArrow(_merge_keys(shards), keys)
        answers = gathered(merged, "shard").applyInArrow(_answer(split), codes)
        answers = gathered(asked, "shard").cogroup(gathered(answers, "block")).applyInArrow(_hand_back(shards), codes)
    sent = rows.groupBy("part", "block").cogroup(gathered(answers, "block")).applyInArrow(_send(length, shards, fan), message)
    if fan > 1:
        sent = addressed(sent).applyInArrow(_merge_segments(length, shards), message)
    found = addressed(sent).applyInArrow(_decide(length, fan), ranges)
    if fan > 1:
        found = gathered(found, "block").applyInArrow(_merge_ranges, ranges)
    return _placed(found, "block", parts)


def _masks(table: pa.Table, found: pa.Table, length: int) -> list[np.ndarray | None]:
    """For each row of a block the mask of its repeated bytes, None where there are none."""
    block = _own(table, length)
    parts = [_unpack(m, _RANGES) for m in found["ranges"].to_pylist()]
    out: list[np.ndarray | None] = [None] * table.num_rows
    if not parts:
        return out
    doc, begin, end = _join_ranges(*(np.concatenate([p[k] for p in parts]) for k in range(1, 4)))
    cuts = np.searchsorted(doc, np.arange(len(block.ids) + 1))
    sizes = np.diff(block.offsets)
    valid = pa.compute.is_valid(table["id"]).to_numpy()
    at = block.ordinals(*(table.filter(table["id"].is_valid())[c].to_numpy().astype("<i8") for c in ("id", "hash")))
    for row, k in zip(np.flatnonzero(valid).tolist(), at.tolist(), strict=True):
        if cuts[k] < cuts[k + 1]:
            mask = np.zeros(int(sizes[k]), bool)
            for a, b in zip(begin[cuts[k]:cuts[k + 1]].tolist(), end[cuts[k]:cuts[k + 1]].tolist(), strict=True):
                mask[a:b] = True
            out[row] = mask
    return out


def removal_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, split: int = SPLIT,
                   direct: int = DIRECT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for each row.

    A byte is removed if a string of ``length`` bytes that covers it also starts in a document with a
    smaller id. Ids are integers. Rows without an id neither repeat nor are repeated; rows that share
    an id don't repeat each other; null, empty and short texts have no strings.
    """

    def digest(table: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for text, mask in zip(table["text"].to_pylist(), _masks(table, found, length), strict=True):
            data = (text or "").encode()
            kept = data if mask is None else np.frombuffer(data, np.uint8)[~mask].tobytes()
            runs = 0 if mask is None else int(np.count_nonzero(mask[1:] > mask[:-1])) + int(mask[0])
            out.append((len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
        columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        return pa.table([table["id"], *columns], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    parts, blocks, shards = layout(docs, text_col)
    rows = _dealt(docs.select(id_col, text_col), id_col, text_col, parts, blocks)
    return (rows.groupBy("part", "block").cogroup(repeated_blocks(rows, parts, shards, length, split, direct).groupBy("part", "block"))
            .applyInArrow(digest, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                    length: int = LENGTH, split: int = SPLIT, direct: int = DIRECT) -> DataFrame:
    """``docs`` with the repeated bytes cut from the texts; ``chars_col``, where there is one, follows.

    A character of several bytes goes only if all of them are repeated, so texts stay valid UTF-8.
    A document of which nothing is left goes; empty and null texts stay as they are.
    """
    parts, blocks, shards = layout(docs, text_col)
    rows = _dealt(docs, id_col, text_col, parts, blocks)
    row = rows.schema["row"].dataType

    def cut(table: pa.Table, found: pa.Table) -> pa.Table:
        kept, changed = [], []
        for text, mask in zip(table["text"].to_pylist(), _masks(table, found, length), strict=True):
            if mask is not None:
                raw = np.frombuffer(text.encode(), np.uint8)
                lead = np.flatnonzero((raw & 0xC0) != 0x80)
                keep = np.maximum.reduceat(~mask, lead)
                text = raw[np.repeat(keep, np.diff(np.append(lead, len(raw))))].tobytes().decode()
            kept.append(text)
            changed.append(mask is not None)
        return pa.table([table["row"], pa.array(kept, pa.string()), pa.array(changed, pa.bool_())], ["row", "kept", "changed"])

    schema = T.StructType([T.StructField("row", row), T.StructField("kept", T.StringType()), T.StructField("changed", T.BooleanType())])
    done = (rows.groupBy("part", "block").cogroup(repeated_blocks(rows, parts, shards, length, split, direct).groupBy("part", "block"))
            .applyInArrow(cut, schema).where("not changed or kept <> ''"))

    def column(c: str):
        if c == text_col:
            return F.col("kept").alias(c)
        old = F.col(f"row.`{c}`")
        if c == chars_col:
            return F.when(F.col("changed"), F.length("kept")).otherwise(old).cast(row[c].dataType).alias(c)
        return old.alias(c)

    return done.select(*[column(c) for c in docs.columns])

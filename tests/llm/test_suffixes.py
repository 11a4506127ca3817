import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataframe.llm import suffixes
from tests.llm.helpers import ODD, PASSAGE, clashing, documents


def plain_masks(rows, length):
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        for p in range(len(data) - length + 1 if i is not None else 0):
            s = data[p:p + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        mask = [False] * len(data)
        for p in range(len(data) - length + 1 if i is not None else 0):
            if first[data[p:p + length]] < i:
                mask[p:p + length] = [True] * length
        out.append((i, data, mask))
    return out


def plain_digest(rows, length):
    out = []
    for i, data, mask in plain_masks(rows, length):
        kept = bytes(b for b, m in zip(data, mask, strict=True) if not m)
        spans = sum(m and (p == 0 or not mask[p - 1]) for p, m in enumerate(mask))
        out.append((i, len(data), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(x):
    return tuple((v is None, v) for v in x)


@given(st.lists(st.binary(min_size=1, max_size=60).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=8), st.integers(2, 9))
@settings(max_examples=150, deadline=None)
def test_two_stage_order_is_the_order_of_suffixes(texts, depth):
    joined = b"\xff".join(texts) + b"\xff"
    text = np.frombuffer(joined + b"\xff" * depth, np.uint8)
    wanted = np.arange(len(text)) < len(joined)
    wanted[len(joined) - 1] = False  # its successor isn't wanted
    small = suffixes.ascending(text)
    wanted &= small | np.append(wanted[1:], False)
    order = suffixes.suffix_order(text, wanted, depth).tolist()
    heads = [text[p:p + depth].tobytes() for p in order]
    assert sorted(order) == np.flatnonzero(wanted).tolist()
    assert heads == sorted(heads)
    lcp = suffixes.common_prefixes(text, np.array(order, np.int64), depth).tolist()
    for a, b, n in zip(heads, heads[1:], lcp[1:], strict=False):
        assert n == next((k for k in range(depth) if a[k] != b[k]), depth)


@pytest.mark.parametrize("direct", [suffixes.DIRECT, 1])
@pytest.mark.parametrize("split", [suffixes.SPLIT, 0])
def test_digest_of_odd_rows(spark, split, direct):
    rows = ODD + [(30 + k, f"{k} " * k + PASSAGE + " tail %d" % k) for k in range(12)] + [(50, PASSAGE + PASSAGE), (51, "y" * 49), (52, "y" * 50), (53, "y" * 51)]
    found = suffixes.removal_digest(clashing(documents(spark, rows)), split=split, direct=direct).collect()
    assert sorted(map(tuple, found), key=key) == sorted(plain_digest(rows, 50), key=key)


def test_digest_of_texts_over_few_letters(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), "".join(rng.choice(list("ab"), int(n)))) for i, n in enumerate(rng.integers(0, 400, 40))]
    found = suffixes.removal_digest(documents(spark, rows), length=12).collect()
    assert sorted(map(tuple, found)) == sorted(plain_digest(rows, 12))


def test_texts_without_repeats(spark):
    docs = clashing(documents(spark, ODD + [(60, "é" * 40), (61, "aé" + "é" * 40 + "b"), (62, "These words are its own, " + PASSAGE)]))
    done = suffixes.without_repeats(docs)
    assert done.columns == docs.columns and done.dtypes == docs.dtypes
    text = {r.doc_id: (r.text, r.n_chars) for r in done.collect() if r.doc_id is not None and r.doc_id != 16}
    assert text[7][0] == ODD[6][1] and text[2] == (None, None) and text[3] == ("", 0)
    assert 8 not in text and 9 not in text  # nothing is left of them
    assert text[62] == ("These words are its own,", 24)  # the space is repeated too
    assert text[61][0] == "ab" and 60 in text
    assert sum(r.doc_id is None for r in done.collect()) == 2


def test_relays_keep_the_ranges_of_texts_over_few_letters(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i) // 2, "".join(rng.choice(list("abc"), int(n)))) for i, n in enumerate(rng.integers(0, 500, 80))]
    for direct in (1, suffixes.DIRECT):
        found = suffixes.removal_digest(documents(spark, rows), length=12, split=5, direct=direct).collect()
        assert sorted(map(tuple, found)) == sorted(plain_digest(rows, 12))


@pytest.mark.parametrize("shards", [16, 64, 256, 1000])
def test_a_block_writes_to_about_the_root_of_the_shards(shards):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdefgh"), 4000)) for _ in range(60)]
    table = pa.table({"block": pa.array([3] * 60), "id": pa.array(range(60)), "hash": pa.array(range(60)), "text": texts})
    fan = suffixes.relay_fan(shards, 1)
    assert (fan - 1) ** 2 < shards <= fan ** 2 and suffixes.relay_fan(shards, shards) == 1
    asked = suffixes._ask(50, shards, fan)(table)
    assert asked.num_rows == -(-shards // fan)
    assert suffixes._ask(50, shards)(table).num_rows > 0.95 * shards
    # a relay writes to the shards that it serves, and keeps the keys
    numbers = [n.as_py() for n in asked["shard"]]
    kept = [suffixes._merge_keys(shards)(asked.slice(k, 1)) for k in range(len(numbers))]
    for number, merged in zip(numbers, kept, strict=True):
        assert {s // fan for s in merged["shard"].to_pylist()} == {number // fan}
    keys = [[k for t in tables for m in t["keys"] for k in np.cumsum(suffixes._unpack(m.as_py(), ("<u8", "<u4", "u1"))[0])] for tables in ([asked], kept)]
    assert sorted(keys[0]) == sorted(keys[1])


@pytest.mark.parametrize("direct", [suffixes.DIRECT, 1])
def test_empty_table(spark, direct):
    docs = documents(spark, [])
    assert suffixes.removal_digest(docs, direct=direct).count() == 0
    assert suffixes.without_repeats(docs).columns == docs.columns


def test_blocks_follow_the_bytes_of_the_texts(spark, monkeypatch):
    rows = ODD + [(30 + k, f"{k} " * k + PASSAGE + " tail %d" % k) for k in range(12)]
    docs = documents(spark, rows)
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert suffixes.partitions(docs, "text") == session
    assert suffixes.partitions(documents(spark, []), "text") == session
    size = sum(len((t or "").encode()) for _, t in rows)
    monkeypatch.setattr(suffixes, "PART_BYTES", size // 20)
    assert 20 <= suffixes.partitions(docs, "text") <= 21
    found = suffixes.removal_digest(docs).collect()
    assert sorted(map(tuple, found), key=key) == sorted(plain_digest(rows, 50), key=key)


def peak_bytes(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def many_segments(rng, docs, length, words):
    """Segments of documents that share many strings: ids, key, run, place, document, text."""
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 8)) for _ in range(words)]
    ids = np.arange(docs, dtype="<i8")
    texts = [" ".join(rng.choice(vocabulary, 900)).encode() for _ in range(docs)]
    raw = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    key, begin, run = suffixes.segments(raw, offsets, length)
    doc = np.searchsorted(offsets, begin, "right") - 1
    return ids, key, run, begin - offsets[doc], doc, suffixes.gather(raw, begin, run + length - 1)


def test_arrays_of_some_keys_at_a_time_find_the_same_ranges():
    columns = many_segments(np.random.default_rng(6), 12, 20, words=60)
    whole = suffixes._join_ranges(*suffixes.repeated_ranges(*columns, 20, array_bytes=1 << 40))
    assert len(whole[0]) > 100
    for size in (1, 5_000, 200_000):
        parts = suffixes._join_ranges(*suffixes.repeated_ranges(*columns, 20, array_bytes=size))
        assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_memory_of_a_shard_does_not_follow_its_suffixes(monkeypatch):
    monkeypatch.setattr(suffixes, "ARRAY_BYTES", 64 << 10, raising=False)
    ids, key, run, place, doc, text = many_segments(np.random.default_rng(7), 120, 50, words=8)
    message = suffixes._pack([c.astype(t) for c, t in zip((ids, ids * 0, ids, key, run, place, doc, text), suffixes._SEGMENTS, strict=True)])
    table = pa.table({"block": pa.array([0]), "shard": pa.array([0]), "message": pa.array([message], pa.binary()), "to": pa.array([0])})
    assert len(text) > 2_000_000
    found, peak = peak_bytes(lambda: suffixes._decide(50)(table))
    assert found.num_rows == 1
    assert peak < 6 * len(text)


def test_blocks_and_shards_follow_the_bytes_whatever_the_partitions(spark, monkeypatch):
    docs = documents(spark, ODD + [(30 + k, f"{k} " * 40 * k + PASSAGE) for k in range(12)])
    size = docs.selectExpr("sum(octet_length(text))").first()[0]
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert suffixes.layout(docs, "text") == (session, session, session)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", size // 40)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", size // 25)
    parts, blocks, shards = suffixes.layout(docs, "text")
    assert parts == session and 40 <= blocks < 40 + 2 * session and 25 <= shards < 25 + 2 * session
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for direct in (suffixes.DIRECT, 1):
        found = suffixes.removal_digest(docs, direct=direct).collect()
        assert sorted(map(tuple, found), key=key) == sorted(plain_digest(rows, 50), key=key)

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strataframe.llm import packing, tokens
from strataframe.llm.common import flat_text, shared_path
from tests.llm.helpers import ODD, clashing, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@given(st.lists(st.text(max_size=60), max_size=5))
@settings(max_examples=150, deadline=None)
def test_words_encode_like_whole_texts(texts):
    texts += ["It's, done. OK.. \x1c x\x85y don't,", "É.,é ño. Straße ΣΑΣ. ﬁ́ é, İ."]
    known = tokens.encoder(PATH)
    assert known.split
    assert encoded(known, texts) == [e.ids for e in known.tokenizer.encode_batch(texts, add_special_tokens=False)]


MARKS = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|startoftext|>", "<|endOfText|>", "<|EndOfTex|>", "<|", "|>", "Word", "É", ".", ",", " ", "\n"]


@given(st.lists(st.lists(st.sampled_from(MARKS), max_size=12).map("".join), max_size=5))
@settings(max_examples=150, deadline=None)
def test_added_tokens_keep_their_case(texts):
    texts += ["<|ENDOFTEXT|>", "a <|StartOfText|>b, <|startoftext|> <|endoftext|>. X<|EndOfText|>,"]
    known = tokens.encoder(PATH)
    want = [e.ids for e in known.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoded(known, texts) == want and encoded(known, texts[::-1]) == want[::-1]
    assert want[-2] == [27, 347, 40786, 4160, 91, 285]


def encoded(known, texts, end=None):
    ids, offsets = known.encode(*flat_text(pa.array(texts, pa.string())), end)
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def test_forgetting_words_changes_nothing():
    small = tokens.WordEncoder(PATH, keep=5, slot_bits=4)
    texts = ["a b c d e f g h, i.", "a b c z. q,", "", "h, h, h, zz. zz yy."]
    for _ in range(2):
        assert encoded(small, texts, 7) == encoded(tokens.encoder(PATH), texts, 7)


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(tokens, "run_hashes", lambda raw, start, length: length.astype(np.uint64) << np.uint64(60))
    texts = ["ab cd ef", "x y z", "ab ab", "", "cd, ab."]
    assert encoded(tokens.WordEncoder(PATH), texts) == encoded(tokens.encoder(PATH), texts)


def test_tokenizers_that_join_words():
    path = public_tokenizers.path("byte_bpe_50k.json")
    known = tokens.WordEncoder(path)
    assert not known.split
    texts = ["two words", " and  three more"]
    assert encoded(known, texts) == [e.ids for e in known.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_files_in_order_and_read_back(spark, tokenizer):
    docs = clashing(documents(spark, ODD))
    path = shared_path(spark, "test-tokens")
    tokens.write_tokens(docs, path, PATH)
    found = sorted(tokens.id_checksums(tokens.read_tokens(spark, path)).collect(), key=lambda r: r.start)
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.id for r in found] == [i for i, _ in rows]
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    start = 0
    for r in found:
        assert r.start == start and any((len(x), crc(x)) == (r.n_tokens, r.ids_crc32) for x in want[r.id])
        start += r.n_tokens
    assert start == sum(len(x) for xs in want.values() for x in xs)
    assert "ids" not in tokens.read_tokens(spark, path, with_ids=False).columns


def test_file_format(spark):
    import glob

    path = shared_path(spark, "test-format")
    rows = [(k, "some words repeat and repeat " * 20 + str(k)) for k in range(200)]
    tokens.write_tokens(documents(spark, rows), path, PATH, partitions=2)
    files = sorted(glob.glob(path.removeprefix("file:") + "/part-*"))
    for f in files:
        meta = pq.ParquetFile(f).metadata
        column = next(meta.row_group(0).column(c) for c in range(meta.num_columns) if "ids" in meta.row_group(0).column(c).path_in_schema)
        assert any("DICTIONARY" in e or "DELTA" in e for e in column.encodings)
        assert column.has_offset_index and column.has_column_index


def test_empty_table(spark):
    assert tokens.token_table(documents(spark, []), PATH).count() == 0
    assert packing.packed_documents(documents(spark, []), PATH).count() == 0


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_pieces_and_sequences(spark, tokenizer):
    capacity = 64
    docs = clashing(documents(spark, ODD))
    packed = packing.pack(packing.pieces(docs, PATH, capacity=capacity, with_ids=True), capacity=capacity)
    rows = packed.collect()
    check_packing(rows, capacity)
    want = []
    for i, t in ODD:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, p // capacity, p, len(ids[p:p + capacity]), crc(ids[p:p + capacity])) for p in range(0, len(ids), capacity)]
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    sequences = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in rows:
        assert sequences[r.sequence_id][r.offset:r.offset + r.length] == r.ids


def test_blocks_of_equal_and_hard_sizes(spark):
    rows = [(k, 34 if k % 2 else 30) for k in range(300)] + [(k, 100) for k in range(300, 320)] + [(None, 1)] * 7
    items = spark.createDataFrame(rows, "id long, length int")
    packed = packing.pack(items, capacity=100, block=64).collect()
    assert len(packed) == len(rows)
    n = check_packing(packed, 100)
    total = sum(x for _, x in rows)
    assert n <= -(-total // 100) * 1.1 + len(rows) / 64 + 1


@given(st.lists(st.integers(1, 50), min_size=1, max_size=60), st.integers(0, 5))
@settings(max_examples=60, deadline=None)
def test_evolution_keeps_every_piece_and_is_no_worse_than_best_fit(sizes, seed):
    sizes = np.sort(np.array(sizes))[::-1].copy()
    first = packing.best_fit(sizes, np.full(len(sizes), -1), np.arange(len(sizes)), 50)
    best = packing.evolve(sizes, [], 50, seed)
    again = packing.evolve(sizes, [best, first], 50, seed + 1)
    for bins in (first, best, again):
        assert bins.min() >= 0 and np.bincount(bins, sizes).max() <= 50 and len(np.unique(bins)) == bins.max() + 1
    assert again.max() <= best.max() <= first.max()

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataframe.llm import tries
from strataframe.llm.queries import QUERIES
from strataframe.sources.tables import load
from tests.conftest import SF001
from tests.llm.helpers import ODD, clashing, documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens(text, scores, worst, fallback=True):
    """One place after the other: best score, then fewest tokens."""
    best = [(0.0, 0)]
    for i in range(1, len(text) + 1):
        unknown = len(text[i - 1].encode()) if fallback else 1
        found = [(best[i - 1][0] + worst, best[i - 1][1] - unknown)]
        found += [(best[j][0] + scores[text[j:i]], best[j][1] - 1) for j in range(max(0, i - 40), i) if text[j:i] in scores]
        best.append(max(found))
    return -best[-1][1]


@pytest.fixture(scope="module")
def scores():
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PATH)
    return {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}


@given(st.lists(st.text("abc\x00é", min_size=1, max_size=12), max_size=30), st.booleans())
@settings(max_examples=150, deadline=None)
def test_counts_over_a_small_vocabulary(words, fallback):
    scores = {"▁": -1.0, "a": -2.0, "b": -2.0, "ab": -3.0, "▁a": -2.5, "abc": -4.0, "bca": -3.0, "ca": -1.5, "éa": -1.0, "bb": -4.0}
    counter = tries.Counter(tries.Pieces(scores, fallback), keep=10)
    want = [plain_tokens("▁" + w, scores, min(scores.values()) - 10, fallback) for w in words]
    assert counter.count([[w] for w in words]) == want
    assert counter.count([words]) == [sum(want)]


def test_whole_texts(spark, scores):
    found = {(r.doc_id, r.n_words, r.n_tokens) for r in tries.token_counts(clashing(documents(spark, ODD)), PATH).collect()}
    worst = min(scores.values()) - 10
    want = {(i, len((t or "").split()), sum(plain_tokens("▁" + w, scores, worst) for w in (t or "").split())) for i, t in ODD}
    assert found == want


def test_unigram_scores_are_log_frequencies(spark):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PATH)
    rows = [*ODD, *((100 + k, "The government gave the information of the people to the information office") for k in range(50))]
    docs = clashing(documents(spark, rows))
    got = tries.unigram_scores(docs.repartition(3), PATH)
    times = np.zeros(sp.get_piece_size())
    for _, t in rows:
        for w in (t or "").split():
            np.add.at(times, sp.encode(w), 1)
    plain = [i for i in range(len(times)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    times[plain] += 1
    assert np.allclose(got[plain], np.log(times[plain] / times[plain].sum()))

    scores = {sp.id_to_piece(i): got[i] for i in plain}
    worst = min(scores.values()) - 10
    found = sorted(((r.doc_id, r.n_tokens) for r in tries.token_counts(docs, PATH, scores=got).collect()), key=repr)
    assert found == sorted(((i, sum(plain_tokens("▁" + w, scores, worst) for w in (t or "").split())) for i, t in rows), key=repr)


def test_ordinary_words_are_one_piece(spark):
    docs = load(spark, SF001, "documents")
    counter = tries.Counter(tries.Pieces.from_file(PATH, tries.unigram_scores(docs, PATH)))
    assert counter.count([["the"], ["government"], ["information"]]) == [1, 1, 1]
    got = {r.doc_id: r.n_tokens for r in QUERIES["op1_token_counts"](spark, SF001).collect()}
    assert all(got[r.doc_id] == counter.count([(r.text or "").split()])[0] for r in docs.collect())
    assert tries.unigram_scores(documents(spark, []), PATH).min() < 0


def test_long_words_and_empty_tables(spark, scores):
    word = "abcé" * 5000
    counter = tries.counter(PATH)
    assert counter.count([[word, "a"]])[0] > 0
    assert counter.count([]) == [] and counter.count([[]]) == [0]
    worst = min(scores.values()) - 10
    assert counter.count([["abcé" * 20]]) == [plain_tokens("▁" + "abcé" * 20, scores, worst)]
    assert tries.trie_counts(np.array(["▁the"]), counter.pieces).tolist() == [plain_tokens("▁the", scores, worst)]
    assert tries.token_counts(documents(spark, []), PATH).count() == 0


@given(st.lists(st.text("abc\x00é", min_size=1, max_size=40), max_size=20), st.booleans())
@settings(max_examples=150, deadline=None)
def test_words_counted_by_themselves(words, fallback):
    scores = {"▁": -1.0, "a": -2.0, "b": -2.0, "ab": -3.0, "▁a": -2.5, "abc": -4.0, "bca": -3.0, "ca": -1.5, "éa": -1.0, "bb": -4.0}
    pieces = tries.Pieces(scores, fallback)
    worst = min(scores.values()) - 10
    assert [tries.long_count("▁" + w, pieces) for w in words] == [plain_tokens("▁" + w, scores, worst, fallback) for w in words]
    assert tries.long_count("ab", tries.Pieces({}, False)) == 2


@pytest.mark.parametrize("n", [tries.LONG - 1, tries.LONG, tries.LONG + 1, 20_000])
def test_words_around_the_bound(scores, n):
    import random

    rng = random.Random(n)
    word = "".join(rng.choice("ABCabcdefghiklmnoprstuvwxyz0123456789+/é") for _ in range(n))
    worst = min(scores.values()) - 10
    assert tries.Counter(tries.Pieces.from_file(PATH)).count([[word]]) == [plain_tokens("▁" + word, scores, worst)]

"""Token counts by dynamic programming over a trie of pre-tokens.

A pre-token is a white-space word behind the word mark of the vocabulary. Its segmentation is the
one with the greatest sum of piece scores; among equal sums, the one with the fewest pieces. The
forward score of a place depends only on the characters before it, so pre-tokens that share a
prefix share its scores: the distinct pre-tokens are inserted in a trie, each new node computes its
forward score from its ancestors', and the node at which a pre-token ends stores its count.

The trie is made of the distinct new pre-tokens of a few megabytes of text, level by level: all nodes
of a level are one numpy step. Very long words are counted one by one, in the same order of sums. No shuffle is needed; a task keeps a bounded table of the counts of
pre-tokens it has met, and what that forgets is computed again.

The scores are those of the vocabulary's file, or ``unigram_scores``: a BPE file has merge ranks
in their place, whose sums mean nothing.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter as Tally
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import give_back

MARK = "▁"
#: Counts of pre-tokens that a task keeps; characters of text whose words go into one trie.
KEEP_COUNTS, STEP_CHARS = 400_000, 4 << 20
#: Characters of a word from which on it is counted by itself: a level of the trie is a numpy step, and
#: hardly any words share so long a prefix.
LONG = 512
#: What a character outside the vocabulary costs more than the worst piece.
UNKNOWN_PENALTY = 10.0

_COUNTERS: dict[tuple[str, int | None], Counter] = {}


def _processor(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def _plain(sp) -> list[int]:
    """Ids of pieces that stand for characters."""
    return [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class Pieces:
    """Piece scores as a trie of characters: state 0 is its root, and ``step`` leads from state and
    character to the next state."""

    def __init__(self, scores: dict[str, float], byte_fallback: bool = True):
        edges: dict[tuple[int, int], int] = {}
        ends = {}
        for piece, score in scores.items():
            state = 0
            for c in piece:
                state = edges.setdefault((state, ord(c)), len(edges) + 1)
            ends[state] = score
        keys = np.array([(s << 21) | c for s, c in edges], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(edges.values()), np.int64)[order]
        self.score = np.full(len(edges) + 1, np.nan)
        self.score[list(ends)] = list(ends.values())
        self.leaf = np.ones(len(edges) + 1, bool)
        self.leaf[[s for s, _ in edges]] = False
        self.worst = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback, self._plain = byte_fallback, None

    @classmethod
    def from_file(cls, path: str, scores: np.ndarray | None = None) -> Pieces:
        """The pieces of a sentencepiece file with its own scores, or with ``scores`` by id."""
        sp = _processor(path)
        score = sp.get_score if scores is None else scores.tolist().__getitem__
        return cls({sp.id_to_piece(i): score(i) for i in _plain(sp)}, any(map(sp.is_byte, range(sp.get_piece_size()))))

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The next states, -1 where no piece goes on so."""
        if not len(self.keys):
            return np.full(len(state), -1)
        asked = (state << 21) | char
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.next[at], -1)

    def plain(self) -> tuple[dict[int, int], dict[int, float], int]:
        """Steps by state and character, scores by state, and one more than the characters of the longest piece."""
        if self._plain is None:
            state, depth = np.zeros(1, np.int64), 0
            while len(state):
                state, depth = self.next[np.isin(self.keys >> 21, state)], depth + 1
            ends = np.flatnonzero(~np.isnan(self.score))
            self._plain = (dict(zip(self.keys.tolist(), self.next.tolist(), strict=True)),
                           dict(zip(ends.tolist(), self.score[ends].tolist(), strict=True)), depth + 1)
        return self._plain

    def unknown_tokens(self, char: np.ndarray) -> np.ndarray:
        """Tokens of characters that no piece covers: their bytes, or one unknown token each."""
        if not self.byte_fallback:
            return np.ones(len(char), np.int64)
        return 1 + (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000)


def trie_counts(words: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Tokens of each of ``words``: distinct strings in ascending order, none empty.

    The words' prefixes of d characters are the trie's nodes of level d. A node computes its forward
    score once, whichever words pass through it; ``open`` holds the pieces under way at a level's
    nodes: node, state among the pieces, score and tokens at which the piece began.
    """
    width = words.dtype.itemsize // 4
    chars = np.ascontiguousarray(words).view(np.uint32).reshape(len(words), width).astype(np.int64)
    length = np.char.str_len(words)
    shared = np.full(len(words), -1)  # characters that a word shares with the one before
    if len(words) > 1:
        differ = chars[1:] != chars[:-1]
        shared[1:] = differ.argmax(1)
    counts = np.zeros(len(words), np.int64)
    node_of = np.zeros(len(words), np.int64)  # of each word, at the level before
    score, tokens = np.zeros(1), np.zeros(1, np.int64)
    none = np.zeros(0, np.int64)
    open_node, open_state, open_score, open_tokens = none, none, np.zeros(0), none
    for level in range(1, width + 1):
        alive = np.flatnonzero(length >= level)
        if not len(alive):
            break
        new = shared[alive] < level
        first = alive[new]
        parent, char = node_of[first], chars[first, level - 1]
        node_of[alive] = np.cumsum(new) - 1
        # pieces that begin at the parents, and those under way there, in order of parent
        every = np.concatenate([open_node, np.arange(len(score))])
        order = np.argsort(every, kind="stable")
        state = np.concatenate([open_state, np.zeros(len(score), np.int64)])[order]
        began, used = np.concatenate([open_score, score])[order], np.concatenate([open_tokens, tokens])[order]
        cuts = np.searchsorted(every[order], np.arange(len(score) + 1))
        times = np.diff(cuts)[parent]
        at = np.arange(int(times.sum())) + np.repeat(cuts[parent] - (np.cumsum(times) - times), times)
        node = np.repeat(np.arange(len(first)), times)
        state = pieces.step(state[at], char[node])
        on = state >= 0
        node, state, began, used = node[on], state[on], began[at[on]], used[at[on]]
        # the best of the pieces that end here, else the character alone
        score, tokens = score[parent] + pieces.worst, tokens[parent] + pieces.unknown_tokens(char)
        end = np.flatnonzero(~np.isnan(pieces.score[state]))
        total, pieces_used, of = began[end] + pieces.score[state[end]], used[end] + 1, node[end]
        best = np.lexsort((pieces_used, -total, of))
        best = best[np.append(True, of[best][1:] != of[best][:-1])] if len(best) else best
        of, total, pieces_used = of[best], total[best], pieces_used[best]
        better = (total > score[of]) | ((total == score[of]) & (pieces_used < tokens[of]))
        score[of[better]], tokens[of[better]] = total[better], pieces_used[better]
        go = ~pieces.leaf[state]
        open_node, open_state, open_score, open_tokens = node[go], state[go], began[go], used[go]
        ended = alive[length[alive] == level]
        counts[ended] = tokens[node_of[ended]]
    return counts


def long_count(word: str, pieces: Pieces) -> int:
    """Tokens of one word of any length, character by character. Only the scores of the next places that a
    piece can reach are held."""
    edges, ends, ring = pieces.plain()
    score, tokens = [-float("inf")] * ring, [0] * ring
    score[0] = 0.0
    chars = np.array([word]).view(np.uint32)
    chars = np.append(chars, np.zeros(len(word) - len(chars), np.uint32))  # NULs at the end
    unknown = pieces.unknown_tokens(chars.astype(np.int64))
    chars, worst, n = array("q", chars.astype(np.int64).tobytes()), pieces.worst, len(word)
    for i in range(n):
        here = i % ring
        base, used = score[here], tokens[here]
        score[here] = -float("inf")
        after = (i + 1) % ring
        total, count = base + worst, used + int(unknown[i])
        if total > score[after] or (total == score[after] and count < tokens[after]):
            score[after], tokens[after] = total, count
        state, count = 0, used + 1
        for j in range(i, n):
            state = edges.get((state << 21) | chars[j])
            if state is None:
                break
            if state in ends:
                total, after = base + ends[state], (j + 1) % ring
                if total > score[after] or (total == score[after] and count < tokens[after]):
                    score[after], tokens[after] = total, count
    return tokens[n % ring]


class Counter:
    """Counts tokens of words; keeps a bounded number of counts."""

    def __init__(self, pieces: Pieces, keep: int = KEEP_COUNTS):
        self.pieces, self.keep, self.counts = pieces, keep, {}

    def _learn(self, words: set[str]) -> None:
        by_length: dict[int, list[str]] = {}  # words of like length, so that arrays hold few blanks
        for w in words:
            by_length.setdefault(max(4, len(w).bit_length()), []).append(w)
        for group in by_length.values():
            distinct = np.sort(np.array([MARK + w for w in group]))
            counts = trie_counts(distinct, self.pieces).tolist()
            self.counts.update(zip((w[1:] for w in distinct.tolist()), counts, strict=True))

    def count(self, texts: list[list[str]]) -> list[int]:
        """The tokens of each text's words."""
        new = {w for words in texts for w in words if w not in self.counts}
        if len(self.counts) + len(new) > self.keep:
            self.counts.clear()
            new = {w for words in texts for w in words}
        # a numpy string ends at its last character that isn't NUL: such words go one by one, as long ones do
        apart = {w for w in new if len(w) > LONG or "\0" in w}
        self._learn(new - apart)
        for w in apart:
            self.counts[w] = long_count(MARK + w, self.pieces)
        get = self.counts.__getitem__
        return [sum(map(get, words)) for words in texts]


def counter(path: str, scores: np.ndarray | None = None) -> Counter:
    key = (path, None if scores is None else zlib.crc32(scores.tobytes()))
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(Pieces.from_file(path, scores))
    return _COUNTERS[key]


def unigram_scores(docs: DataFrame, model: str, text_col: str = "text") -> np.ndarray:
    """Log relative frequencies of the pieces of ``model``, by id: how often each occurs in all of
    ``docs`` as sentencepiece segments their words, and once more for each piece (so none is 0)."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(model)
        total, words = np.zeros(sp.get_piece_size(), np.int64), Tally()

        def add() -> None:
            ids = sp.encode(list(words), num_threads=1)
            times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.fromiter(map(len, ids), np.int64, len(ids)))
            np.add.at(total, np.fromiter((i for part in ids for i in part), np.int64, len(times)), times)
            words.clear()

        for batch in batches:
            for text in batch.column(0):
                words.update((text.as_py() or "").split())
                if len(words) > KEEP_COUNTS:
                    add()
            give_back()
        add()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "n"])

    # at most one row for each piece of the vocabulary
    rows = docs.select(text_col).mapInArrow(tally, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    sp = _processor(model)
    times, plain = np.zeros(sp.get_piece_size()), _plain(sp)
    for r in rows:
        times[r["piece"]] = r["n"]
    times[plain] += 1
    scores = np.zeros(len(times))
    scores[plain] = np.log(times[plain] / times[plain].sum())
    return scores


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", scores: np.ndarray | None = None) -> DataFrame:
    """(id, n_words, n_tokens) of each row: white-space words, and tokens of all of them.

    ``model`` is the path of a sentencepiece file, ``scores`` those of its pieces by id where they are not
    the file's. Null, empty and blank texts have none. Rows without an id and rows that share one are rows of their own.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(model, scores)
        for batch in batches:
            words, tokens, held, size = [], [], [], 0
            for text in batch.column(1):
                text = text.as_py() or ""
                held.append(text.split())
                words.append(len(held[-1]))
                size += len(text)
                if size >= STEP_CHARS:
                    tokens += known.count(held)
                    held, size = [], 0
            tokens += known.count(held)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["id", "n_words", "n_tokens"])
            give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, f"id {id_type}, n_words long, n_tokens long").withColumnRenamed("id", id_col)

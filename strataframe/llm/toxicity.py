"""Convolutional text classifier over hashed word embeddings, trained here in numpy.

A word's embedding is the sum of three rows of one table, chosen by hashes of the word, of its first
and of its last bytes. Filters of several widths slide over a text's words; each keeps its
greatest response (max pooling over the whole text); a dense layer turns these into a logit. The
threshold is calibrated for each language, which is guessed from the text's own function words.

All labelled rows are learnt from. They are dealt into parts by id; in each round every part goes on from the same model
in a task of its own, and what the parts changed is averaged, parameter by parameter, over those that changed it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.llm.common import chunks, give_back, mix64, noted, remove_tables, run_hashes, text_steps, token_runs, written
from strataframe.llm.phrases import Filter

TABLE_BITS, DIM, WIDTHS, FILTERS = 16, 16, (1, 2, 3), 12
#: Bytes at the ends of a word with an embedding of their own.
EDGE = 4
#: Words of a part of the labelled rows, about, and bytes of a word with what follows it.
TRAIN_WORDS, WORD_BYTES = 6_000_000, 6
#: Passes over the rows, and steps at least, whichever is more; rounds that the passes are shared out to.
EPOCHS, STEPS, BATCH, RATE, DECAY, ROUNDS = 6, 1000, 32, 0.01, 1e-5, 3
#: One of so many labelled rows only calibrates; rows of each label that a language needs for a threshold of its own.
CALIBRATION, LANGUAGE_ROWS = 5, 20
#: Calibrating logits are counted in steps of one of so many, up to a greatest one.
GRID, GREATEST = 64, 32
STEP_BYTES, STEP_WORDS = 512 << 10, 1 << 16
#: Rows of parameters that travel together.
BLOCK = 256

#: Frequent function words by language.
FUNCTION_WORDS = {
    "de": "der die das und ist nicht ein eine zu mit auf für von den sich",
    "en": "the of and to in is that for was with on are this be",
    "es": "el los las y que del se por con una un para es en",
    "fr": "le les des et est un une dans pour que qui sur pas avec au",
}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)]).astype(np.uint8)


def _hash_words(words: list[str]) -> np.ndarray:
    size = np.array([len(w.encode()) for w in words])
    raw = np.frombuffer("".join(words).encode() + bytes(8), np.uint8)
    return run_hashes(raw, np.cumsum(size) - size, size)


LANGUAGES = [*FUNCTION_WORDS, ""]
_MARKERS = np.concatenate([_hash_words(w.split()) for w in FUNCTION_WORDS.values()])
_MARKER_LANGUAGE = np.repeat(np.arange(len(FUNCTION_WORDS)), [len(w.split()) for w in FUNCTION_WORDS.values()])


def word_rows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of the table for each word, words before each text, language of each text)."""
    low = _LOWER[raw]
    start, end, text, _ = token_runs(low, offsets, _WORD)
    size = end - start
    edge = np.minimum(size, EDGE)
    whole = run_hashes(low, start, size)
    rows = np.stack([whole, run_hashes(low, start, edge, 1), run_hashes(low, end - edge, edge, 2)], 1) >> np.uint64(64 - TABLE_BITS)
    order = np.argsort(_MARKERS)
    at = order[np.minimum(np.searchsorted(_MARKERS, whole, sorter=order), len(order) - 1)]
    hit = _MARKERS[at] == whole
    n = len(offsets) - 1
    seen = np.bincount(text[hit] * len(FUNCTION_WORDS) + _MARKER_LANGUAGE[at[hit]], minlength=n * len(FUNCTION_WORDS)).reshape(n, -1)
    language = np.where(seen.max(1) > 0, seen.argmax(1), len(FUNCTION_WORDS))
    return rows.astype(np.int32), np.searchsorted(text, np.arange(n + 1)), language


@dataclass
class Convolution:
    """Parameters, and the thresholds of LANGUAGES as logits."""

    table: np.ndarray
    filters: list[np.ndarray]  # of each width: (width, DIM, FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    offset: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))

    @classmethod
    def start(cls, seed: int = 0) -> Convolution:
        rng = np.random.default_rng(seed)
        filters = [rng.normal(0, 1 / np.sqrt(DIM * w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        pooled = FILTERS * len(WIDTHS)
        return cls(rng.normal(0, 0.1, (1 << TABLE_BITS, DIM)).astype(np.float32), filters, np.zeros(pooled, np.float32),
                   np.full(pooled, 0.3, np.float32), -1.0)

    def pooled(self, rows: np.ndarray, before: np.ndarray, places: bool = False):
        """Greatest response of each filter in each text (0 where no window fits), and its place."""
        n = len(before) - 1
        out = np.zeros((n, len(self.bias)), np.float32)
        at = np.full((n, len(self.bias)), -1)
        if not len(rows):
            return out, at
        words = np.take(self.table, rows[:, 0], 0)
        for c in (1, 2):
            words += np.take(self.table, rows[:, c], 0)
        size = np.diff(before)
        for k, (width, filt) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            use = np.flatnonzero(size >= width)
            if not len(use):
                continue
            m = len(words) - width + 1
            got = words[:m] @ filt[0]
            for j in range(1, width):
                got += words[j:m + j] @ filt[j]
            # windows that would cross the end of a text
            bad = (before[use + 1][:, None] - np.arange(1, width)).ravel()
            got[bad[bad < m]] = -np.inf
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            # texts with no window lie between the begins of those that have some: their words are masked
            for t in np.flatnonzero((size < width) & (size > 0)):
                got[before[t]:min(before[t + 1], m)] = -np.inf
            best = np.maximum.reduceat(got, before[use], axis=0)
            out[use, cols] = best
            if places:
                for i, t in enumerate(use):
                    a, b = before[t], min(before[t + 1], m)
                    at[t, cols] = a + (got[a:b] == best[i]).argmax(0)
        return out, at

    def logits(self, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
        out, _ = self.pooled(rows, before)
        return np.maximum(out + self.bias, 0) @ self.dense + self.offset

    def step(self, rows: np.ndarray, before: np.ndarray, label: np.ndarray, rate: float, memory: dict) -> None:
        """One step of Adagrad, with sums of squares of each parameter in ``memory``, on the logistic loss of a batch."""
        raw, at = self.pooled(rows, before, places=True)
        hidden = np.maximum(raw + self.bias, 0)
        error = (1 / (1 + np.exp(-(hidden @ self.dense + self.offset))) - label) / len(label)
        back = error[:, None] * self.dense * (hidden > 0) * (at >= 0)
        grads = [np.zeros_like(f) for f in self.filters]
        touched, changes = [], []
        for k, (width, filt) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            text, col = np.nonzero(back[:, cols])
            place, amount = at[:, cols][text, col], back[:, cols][text, col]
            for j in range(width):
                words = rows[place + j]
                value = self.table[words].sum(1)
                grads[k][j] = value.T @ (amount[:, None] * (col[:, None] == np.arange(FILTERS)))
                touched.append(words), changes.append(amount[:, None] * filt[j][:, col].T)

        def move(name: str, value: np.ndarray, grad: np.ndarray, where=...):
            sums = memory[name]
            sums[where] += grad * grad
            value[where] -= rate * grad / np.sqrt(sums[where])

        move("dense", self.dense, hidden.T @ error + DECAY * self.dense)
        move("bias", self.bias, back.sum(0))
        for k, g in enumerate(grads):
            move(f"filter{k}", self.filters[k], g + DECAY * self.filters[k])
        self.offset -= rate * float(error.sum())
        if touched:
            flat = np.concatenate(touched).ravel()
            if len(flat):
                order = np.argsort(flat, kind="stable")
                row, first = np.unique(flat[order], return_index=True)
                move("table", self.table, np.add.reduceat(np.concatenate(changes)[order // 3], first, axis=0), row)


def _views(state: np.ndarray) -> dict[str, np.ndarray]:
    """The parameters in rows of DIM numbers: those of the table, then all others."""
    rest, out, at = state[1 << TABLE_BITS:].reshape(-1), {"table": state[:1 << TABLE_BITS]}, 0
    pooled = FILTERS * len(WIDTHS)
    for name, shape in (*((f"filter{k}", (w, DIM, FILTERS)) for k, w in enumerate(WIDTHS)), ("bias", (pooled,)), ("dense", (pooled,)), ("offset", (1,))):
        size = int(np.prod(shape))
        out[name], at = rest[at:at + size].reshape(shape), at + size
    return out


STATE_ROWS = (1 << TABLE_BITS) + -(-(sum(WIDTHS) * DIM * FILTERS + 2 * FILTERS * len(WIDTHS) + 1) // DIM)


def start_state(seed: int = 0) -> np.ndarray:
    model, state = Convolution.start(seed), np.zeros((STATE_ROWS, DIM), np.float32)
    views = _views(state)
    for name, value in (("table", model.table), *((f"filter{k}", f) for k, f in enumerate(model.filters)), ("bias", model.bias),
                        ("dense", model.dense), ("offset", model.offset)):
        views[name][...] = value
    return state


def model_of(state: np.ndarray) -> Convolution:
    """The model whose parameters are ``state`` (its own memory, but for the offset)."""
    v = _views(state)
    return Convolution(v["table"], [v[f"filter{k}"] for k in range(len(WIDTHS))], v["bias"], v["dense"], float(v["offset"][0]))


def learn(state: np.ndarray, sums: np.ndarray, rows: np.ndarray, before: np.ndarray, label: np.ndarray, passes: int, seed) -> tuple[np.ndarray, np.ndarray]:
    """Parameters and Adagrad's sums of squares after ``passes`` over texts with labels 0 and 1."""
    state, sums, rng = state.copy(), sums.copy(), np.random.default_rng(seed)
    model, memory, n = model_of(state), _views(sums), len(label)
    for _ in range(passes):
        for part in np.array_split(rng.permutation(n), max(1, n // BATCH)):
            size = np.diff(before)[part]
            index = np.arange(int(size.sum())) + np.repeat(before[part] - (np.cumsum(size) - size), size)
            model.step(rows[index], np.append(0, np.cumsum(size)), label[part], RATE, memory)
    _views(state)["offset"][0] = model.offset
    return state, sums


def threshold(bins: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """Half way between the logits that classify best, of the rows counted at ascending steps of the logit: with the
    fewest errors, each class counting alike."""
    got = bins / GRID
    edges = np.concatenate([[got[0] - 1], (got[1:] + got[:-1]) / 2, [got[-1] + 1]])
    missed = np.append(0, np.cumsum(toxic)) / max(1, toxic.sum())
    false = np.append(np.cumsum(clean[::-1])[::-1], 0) / max(1, clean.sum())
    cost = missed + false
    best = np.flatnonzero(cost == cost.min())
    return float(edges[best[len(best) // 2]])


def thresholds(counts: np.ndarray, target: float = 0.5) -> np.ndarray:
    """Of each language, so that a score reaches ``target`` at the best one; ``counts`` holds calibrating rows by
    language, step of the logit and label."""
    def best(use: np.ndarray) -> float | None:
        if use.sum(0).min() < LANGUAGE_ROWS:
            return None
        bins = np.flatnonzero(use.any(1))
        return threshold(bins - GREATEST * GRID, use[bins, 0], use[bins, 1])

    everywhere = best(counts.sum(0)) or 0.0
    own = [best(of) for of in counts]
    return np.array([everywhere if t is None else t for t in own]) - np.log(target / (1 - target))


def scores(model: Convolution, rows: np.ndarray, before: np.ndarray, language: np.ndarray) -> np.ndarray:
    z = model.logits(rows, before).astype(float) - model.thresholds[language]
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


# ------------------------------------------------------------------ on tables
def _texts_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the table for each word, words before each text) of written texts."""
    size = batch.column("n").to_numpy()
    blobs = [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column("words")]
    return np.concatenate([np.zeros(0, "<u2"), *blobs]).reshape(-1, 3), np.append(0, np.cumsum(size)).astype(np.int64)


def _one_round(dealt: DataFrame, state: np.ndarray, sums: np.ndarray, passes: int, words: int, seed: int) -> None:
    """Parameters and sums after every part has gone on from them: each moves by the mean of the moves of the parts that
    moved it, weighted by their rows."""

    def units(batches: Iterator[pa.RecordBatch]):
        """(part, rows, before, label): rows of one part that follow each other, up to twice ``words`` and a batch."""
        held, part, total = [], None, 0
        for batch in batches:
            own = batch.column("part").to_numpy()
            for piece in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own)) + 1) if len(own) else []:
                if held and (own[piece[0]] != part or total > 2 * words):
                    yield part, held
                    held, total = [], 0
                part = int(own[piece[0]])
                held.append(batch.slice(piece[0], len(piece)))
                total += int(held[-1].column("n").to_numpy().sum())
        if held:
            yield part, held

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in units(batches):
            rows, sizes = zip(*(_texts_of(b) for b in held), strict=True)
            label = np.concatenate([b.column("label").to_numpy() for b in held]).astype(np.float32)
            before = np.append(0, np.cumsum(np.concatenate([np.diff(x) for x in sizes])))
            del held
            new, squares = learn(state, sums, np.concatenate(rows), before, label, passes, [seed, part])
            del rows
            change = np.concatenate([new - state, squares - sums], 1)
            moved = np.flatnonzero(change.any(1))
            blocks = np.split(moved, np.flatnonzero(np.diff(moved // BLOCK)) + 1) if len(moved) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x[0]) // BLOCK for x in blocks], pa.int32()), pa.array(np.full(len(blocks), part, np.int32)),
                 pa.array(np.full(len(blocks), len(label), np.int64)), pa.array([x.astype("<i4").tobytes() for x in blocks], pa.binary()),
                 pa.array([change[x].tobytes() for x in blocks], pa.binary())], ["block", "part", "weight", "moved", "change"])
        give_back()

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # of a block: weighted changes, weights
        for batch in batches:
            for block, weight, moved, change in zip(*(batch.column(c) for c in ("block", "weight", "moved", "change")), strict=True):
                own = total.setdefault(block.as_py(), np.zeros((BLOCK, 2 * DIM + 1)))
                at = np.frombuffer(moved.as_buffer(), "<i4") % BLOCK
                own[at, :-1] += weight.as_py() * np.frombuffer(change.as_buffer(), "<f4").reshape(-1, 2 * DIM)
                own[at, -1] += weight.as_py()
        value = [(own[:, :-1] / np.maximum(own[:, -1:], 1)).astype("<f4").tobytes() for own in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(value, pa.binary())], ["block", "change"])

    moved = dealt.mapInArrow(moves, "block int, part int, weight long, moved binary, change binary").repartition("block")
    for r in moved.sortWithinPartitions("block", "part", "weight").mapInArrow(mean, "block int, change binary").collect():  # the size of the model
        at = slice(r.block * BLOCK, min((r.block + 1) * BLOCK, STATE_ROWS))
        change = np.frombuffer(r.change, "<f4").reshape(BLOCK, 2 * DIM)[:at.stop - at.start]
        state[at] += change[:, :DIM]
        sums[at] += change[:, DIM:]


def _calibrating(dealt: DataFrame, model: Convolution) -> np.ndarray:
    """Rows by language, step of the logit and label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, before = _texts_of(batch)
            z = [model.logits(rows[before[a]:before[b]], before[a:b + 1] - before[a]) for a, b in chunks(before, STEP_WORDS)]
            step = np.rint(np.clip(np.concatenate([np.zeros(0), *z]), -GREATEST, GREATEST) * GRID).astype(np.int64) + GREATEST * GRID
            key, n = np.unique(np.stack([batch.column("language").to_numpy(), step, batch.column("label").to_numpy()]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(k.astype(np.int32)) for k in key), pa.array(n.astype(np.int64))], ["language", "step", "label", "n"])
        give_back()

    out = np.zeros((len(LANGUAGES), 2 * GREATEST * GRID + 1, 2), np.int64)
    found = dealt.mapInArrow(count, "language int, step int, label int, n long").groupBy("language", "step", "label").agg(F.sum("n").alias("n"))
    for r in found.collect():  # at most the size of ``out``
        out[r.language, r.step, r.label] = r.n
    return out


def train(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, target: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text", words: int = TRAIN_WORDS, seed: int = 0) -> Convolution:
    """A model of all documents with a label 0 or 1 and ``usable`` ids, whole texts, whose score reaches ``target`` at
    each language's best threshold.

    A fifth of the rows, by a hash of id and text, finds the thresholds, all others the parameters; where the fifth has
    too few rows of a label for thresholds, it learns with the others. ``words`` is about what a task holds at a time.
    Of labels that share an id the greatest counts; each document row of the id is learnt from.
    """
    spark = docs.sparkSession
    with noted() as tables:
        marks = labels.where(usable & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
        marks = written(marks.where("label in (0, 1)"), "labelled")
        texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"), F.xxhash64(id_col).alias("own"))
        size = texts.select("id", F.octet_length("text").alias("size")).join(marks, "id").agg(F.sum("size")).first()[0] or 0
        parts = max(1, -(-size // (words * WORD_BYTES)))
        labelled = Filter(marks.select(F.xxhash64("id").alias("own")), "own")  # spares the exchange the texts without a label, but for a few

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                batch = batch.filter(pa.array(labelled(batch.column("own").to_numpy().view(np.uint64))))
                for first, stop, raw, offsets in text_steps(batch.column("text"), STEP_BYTES):
                    rows, before, language = word_rows(raw, offsets)
                    blobs = [x.tobytes() for x in np.split(rows.astype("<u2"), before[1:-1])]
                    own = batch.column("own").slice(first, stop - first).to_numpy().view(np.uint64)
                    deal = mix64(run_hashes(raw, offsets[:-1], np.diff(offsets)) ^ own)
                    order = np.argsort(deal, kind="stable")  # of rows that repeat as a whole, some calibrate and some teach
                    same = np.arange(len(deal)) - np.searchsorted(deal[order], deal[order])
                    deal[order] += same.astype(np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").slice(first, stop - first), pa.array(deal % np.uint64(CALIBRATION) == 0), pa.array(deal.view(np.int64)),
                         pa.array(language.astype(np.int32)), pa.array(np.diff(before)), pa.array(blobs, pa.binary())],
                        ["id", "tune", "deal", "language", "n", "words"])

        shape = T.StructType([texts.schema["id"], *T.StructType.fromDDL("tune boolean, deal long, language int, n long, words binary").fields])
        both = texts.mapInArrow(read, shape).unionByName(marks, allowMissingColumns=True).repartition(parts, "id")
        both = both.withColumn("label", F.max("label").over(Window.partitionBy("id"))).where("label is not null and words is not null")
        found = both.select(F.pmod(F.hash("id"), F.lit(parts)).alias("part"), "tune", "deal", "label", "language", "n", "words")
        dealt = written(found.sortWithinPartitions("part", "deal", "label"), "parts")  # one exchange deals out texts and labels
        seen = np.zeros((2, 2), np.int64)  # by tune and label
        for r in dealt.groupBy("tune", "label").count().collect():
            seen[int(r.tune), r.label] = r["count"]
        calibrates = seen[1].min() >= LANGUAGE_ROWS and seen[0].min() > 0
        teachers = dealt.where("not tune") if calibrates else dealt
        n = int(seen[0].sum() if calibrates else seen.sum())
        state, sums = start_state(seed), np.full((STATE_ROWS, DIM), 1e-8, np.float32)
        if seen.sum(0).min() > 0:
            passes = -(-max(EPOCHS, -(-STEPS * BATCH // n)) // ROUNDS)
            for k in range(ROUNDS):
                _one_round(teachers, state, sums, passes, words, seed * ROUNDS + k)
        else:  # nothing to learn: the share of label 1; without positives, also without any row, that is below one half
            share = (seen[:, 1].sum() + 0.5) / (max(n, 1) + 1)
            _views(state)["dense"][:] = 0
            _views(state)["offset"][:] = np.log(share / (1 - share))
        model = model_of(state)
        counts = _calibrating(dealt.where("tune"), model) if calibrates else np.zeros((len(LANGUAGES), 2 * GREATEST * GRID + 1, 2), np.int64)
        model.thresholds = thresholds(counts, target)
    remove_tables(spark, tables)
    return model


def with_score(docs: DataFrame, model: Convolution, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, from 0 to 1; null and empty texts have one too."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    place = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros(0)]
            for _, _, piece, offsets in text_steps(batch.column(place), STEP_BYTES):
                parts.append(scores(model, *word_rows(piece, offsets)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts))], [*batch.schema.names, out])

    return docs.mapInArrow(score, schema)

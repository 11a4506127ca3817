"""Packing token sequences into as few bins as it can, by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt into blocks of bounded
size by a hash; every block is packed on its own, so a block costs at most part of one bin more.
A block is worked on by several islands, each with a population of packings:

* crossover injects whole well-filled bins of one parent into the other, removes the bins in which
  their pieces occur a second time, and best-fits the pieces that this displaces;
* mutation empties the worst-filled bins and best-fits their pieces;
* between rounds each island passes its best packing on to the next one (a join of the written
  state of the round before).

Spark deals the islands out and moves the elites; an island is a row of arrays of bounded size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import text_steps, written
from strataframe.llm.tokens import STEP_BYTES, encoder

CAPACITY, END_ID = 4096, 1
#: Pieces of a block on average; islands of a block; rounds, and generations of each; packings of an island.
BLOCK, ISLANDS, ROUNDS, GENERATIONS, POPULATION = 16_384, 2, 2, 12, 4


# ------------------------------------------------------------------ one packing
class OpenBins:
    """Open bins by the room they have left; finds the one that fits best."""

    def __init__(self, capacity: int):
        self.capacity, self.by_room, self.rooms = capacity, {}, 0  # rooms: bit r is set if a bin has r left

    def add(self, number: int, room: int) -> None:
        if room:
            self.by_room.setdefault(room, []).append(number)
            self.rooms |= 1 << room

    def take(self, size: int) -> tuple[int, int] | None:
        """Number and room of the open bin with the least room of at least ``size``."""
        fits = self.rooms >> size
        if not fits:
            return None
        room = size + (fits & -fits).bit_length() - 1
        found = self.by_room[room]
        number = found.pop()
        if not found:
            self.rooms ^= 1 << room
        return number, room


def best_fit(sizes: np.ndarray, bins: np.ndarray, todo: np.ndarray, capacity: int) -> np.ndarray:
    """``bins`` (the bin of each piece, -1 for none) with the pieces ``todo`` placed in that order,
    each where it leaves the least room; bins are numbered anew from 0."""
    bins = bins.copy()
    placed = bins >= 0
    used, bins[placed] = np.unique(bins[placed], return_inverse=True)
    fill = np.bincount(bins[placed], sizes[placed], len(used)).astype(np.int64)
    n, open_bins = len(used), OpenBins(capacity)
    for number in np.flatnonzero(fill < capacity).tolist():
        open_bins.add(number, int(capacity - fill[number]))
    for piece, size in zip(todo.tolist(), sizes[todo].tolist(), strict=True):
        got = open_bins.take(size)
        if got is None:
            got, n = (n, capacity), n + 1
        bins[piece] = got[0]
        open_bins.add(got[0], got[1] - size)
    return bins


def quality(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Orders packings: fewer bins first, then more unevenly filled ones. Greater is better."""
    fill = np.bincount(bins, sizes)
    return -len(fill), float(np.square(fill / capacity).sum())


def crossover(sizes: np.ndarray, giver: np.ndarray, taker: np.ndarray, capacity: int, rng) -> np.ndarray:
    fill = np.bincount(giver, sizes)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(good, max(1, len(good) // 8), replace=False)] = True
    injected = chosen[giver]
    broken = np.zeros(int(taker.max()) + 1, bool)
    broken[taker[injected]] = True
    displaced = broken[taker] & ~injected
    child = np.where(injected, giver + len(broken), np.where(displaced, -1, taker))
    return best_fit(sizes, child, np.flatnonzero(displaced), capacity)


def mutate(sizes: np.ndarray, bins: np.ndarray, capacity: int, rng) -> np.ndarray:
    fill = np.bincount(bins, sizes)
    worst = np.argsort(fill + rng.random(len(fill)) * capacity / 8)[:max(2, len(fill) // 20)]
    emptied = np.isin(bins, worst)
    todo = np.flatnonzero(emptied)
    child = np.where(emptied, -1, bins)
    return best_fit(sizes, child, todo[np.argsort(-sizes[todo] * (1 + rng.random(len(todo)) / 4), kind="stable")], capacity)


def evolve(sizes: np.ndarray, elites: list[np.ndarray], capacity: int, seed: int) -> np.ndarray:
    """The best packing after GENERATIONS. ``sizes`` descend; ``elites`` are packings to start from."""
    rng = np.random.default_rng(seed)
    empty, bound = np.full(len(sizes), -1, np.int64), -(-int(sizes.sum()) // capacity)
    population = [np.asarray(e, np.int64) for e in elites]
    if not population:
        population.append(best_fit(sizes, empty, np.arange(len(sizes)), capacity))
    ranked = sorted(((quality(sizes, p, capacity), k, p) for k, p in enumerate(population)), reverse=True)
    if -ranked[0][0][0] <= bound:  # no packing has fewer bins
        return ranked[0][2]
    while len(ranked) < POPULATION:
        order = np.argsort(-sizes * (1 + rng.random(len(sizes)) / 2), kind="stable")
        p = best_fit(sizes, empty, order, capacity)
        ranked.append((quality(sizes, p, capacity), len(ranked), p))
    for k in range(GENERATIONS):
        ranked.sort(reverse=True)
        if -ranked[0][0][0] <= bound:
            break
        a, b = rng.choice(len(ranked) - 1, 2, replace=False)
        child = crossover(sizes, ranked[a][2], ranked[b][2], capacity, rng)
        if k % 2:
            child = mutate(sizes, child, capacity, rng)
        ranked[-1] = quality(sizes, child, capacity), POPULATION + k, child
    return max(ranked)[2]


# ------------------------------------------------------------------ blocks and islands
def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of whole texts; null texts are the end id alone."""
    id_type = docs.schema[id_col].dataType.simpleString()
    fields = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part, own in text_steps(batch.column(1), STEP_BYTES):
                flat, at = encoder(tokenizer).encode(part, own, end_id)
                size = np.diff(at)
                count = -(-size // capacity)
                which = np.repeat(np.arange(b - a), count)
                number = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                begin = at[which] + number * capacity
                length = np.minimum(at[which + 1] - begin, capacity)
                view = memoryview(flat).cast("B")
                sums = [zlib.crc32(view[4 * x:4 * (x + n)]) for x, n in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [batch.column(0).slice(a, b - a).take(pa.array(which)), pa.array(number.astype(np.int32)), pa.array(number * capacity),
                           pa.array(length), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(flat)).astype(np.int32)), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(columns, fields)

    ids = ", ids array<int>" if with_ids else ""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        cut, f"id {id_type}, piece int, start long, length long, ids_crc32 long{ids}")


def _evolver(capacity: int, round_: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, island = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                sizes = batch.column(2)[row].values.to_numpy().astype(np.int64)
                elites = [batch.column(c)[row].values.to_numpy() for c in range(3, batch.num_columns) if batch.column(c)[row].is_valid]
                best = evolve(sizes, elites, capacity, hash((block, island, round_)) & 0x7FFFFFFF)
                n, uneven = quality(sizes, best, capacity)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([island], pa.int32()), batch.column(2).slice(row, 1), pa.array([best.astype(np.int32)], pa.list_(pa.int32())), pa.array([-n], pa.int64()), pa.array([uneven])],
                    ["block", "island", "sizes", "best", "n_bins", "uneven"])

    return run


_STATE = "block long, island int, sizes array<int>, best array<int>, n_bins long, uneven double"


def _layout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, rank, bin, offset) of the pieces of each block's packing."""
    for batch in batches:
        for row in range(batch.num_rows):
            sizes = batch.column(1)[row].values.to_numpy().astype(np.int64)
            bins = batch.column(2)[row].values.to_numpy().astype(np.int64)
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(sizes[order])
            first = np.append(True, bins[order][1:] != bins[order][:-1])
            begin = ends - sizes[order]
            offset = np.empty(len(sizes), np.int64)
            offset[order] = begin - np.maximum.accumulate(np.where(first, begin, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sizes), batch.column(0)[row].as_py())), pa.array(np.arange(len(sizes), dtype=np.int32)), pa.array(bins), pa.array(offset)],
                ["block", "rank", "bin", "offset"])


def pack(items: DataFrame, length_col: str = "length", capacity: int = CAPACITY, block: int = BLOCK,
         islands: int = ISLANDS, rounds: int = ROUNDS) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: rows of 1 to ``capacity`` tokens packed into
    sequences of at most ``capacity``, gapless from 0. An empty table gives an empty table."""
    names = items.columns
    rows = written(items.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                                F.col(f"`{length_col}`").cast("int").alias("size"), F.monotonically_increasing_id().alias("uid")), "pieces")
    blocks = max(1, -(-rows.count() // block))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("long"))
    sizes = dealt.groupBy("block").agg(F.sort_array(F.collect_list("size"), asc=False).alias("sizes"))  # about `block` numbers
    now = sizes.select("block", F.explode(F.array(*[F.lit(k) for k in range(islands)])).alias("island"), "sizes")
    for k in range(rounds):
        state = now.repartition("block", "island").mapInArrow(_evolver(capacity, k), _STATE)
        now = state = written(state, "islands")
        if k + 1 < rounds:
            guest = state.select(F.col("block").alias("b"), F.pmod(F.col("island") + 1, F.lit(islands)).alias("i"), F.col("best").alias("guest"))
            now = state.join(guest, (F.col("block") == F.col("b")) & (F.col("island") == F.col("i"))).select("block", "island", "sizes", "best", "guest")
    winner = state.groupBy("block").agg(F.min_by(F.struct("sizes", "best"), F.struct("n_bins", -F.col("uneven"), "island")).alias("w"))
    layout = winner.select("block", "w.sizes", "w.best").mapInArrow(_layout, "block long, rank int, bin long, offset long")
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("block").orderBy(F.desc("size"), "uid")) - 1)
    joined = ranked.join(layout.withColumnsRenamed({"block": "b", "rank": "r"}), (F.col("block") == F.col("b")) & (F.col("rank") == F.col("r")))
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in names if c not in ("sequence_id", "offset")],
                         (F.shiftleft("block", 32) + F.col("bin")).alias("sequence_id"), "offset")


def packed_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of all pieces of ``docs``."""
    cut = pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids)
    return pack(cut, capacity=capacity).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces that carry their ids: each sequence's ids in order of offset."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))

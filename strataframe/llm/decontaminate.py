"""Benchmark decontamination by winnowing.

A text's fingerprints are the least hashes of its k-word grams in each window of w neighbouring
grams. Two texts that share span = k + w - 1 words share the fingerprint of that span, so joining
the fingerprints of documents and benchmark finds every shared span. Around each hit, the windows
of a document that hold the hit are compared with the benchmark's windows word by word.

An item of fewer words than the span is one window of its own; each such length (there are fewer
than ``span``) has fingerprints of its own, with k and w to fit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import mix64, run_hashes, sliding_max, sliding_min, text_steps, token_runs, written

SPAN = 10
#: Fixed by the task: words after lower-casing A-Z.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STEP_BYTES = 512 << 10

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASSES = np.array([re.fullmatch(WORD, bytes([_LOWER[b]])) is not None for b in range(256)], np.uint8)


def gram_sizes(span: int) -> tuple[int, int]:
    """(k, w) with k + w - 1 = span."""
    k = (span + 1) // 2
    return k, span - k + 1


def winnow(word_hash: np.ndarray, row: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, fingerprint) of the grams that are least in some window; windows stay in their row."""
    k, w = gram_sizes(span)
    n = len(word_hash)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = np.full(n - k + 1, span, np.uint64)
    for j in range(k):
        gram = (gram ^ word_hash[j:j + len(gram)]) * np.uint64(0x9FB21C651E98DF25)
        gram ^= gram >> np.uint64(31)
    gram = mix64(gram)
    low = sliding_min(gram, w)
    low[row[:len(low)] != row[span - 1:span - 1 + len(low)]] = 0
    edge = np.zeros(w - 1, np.uint64)
    chosen = sliding_max(np.concatenate([edge, low, edge]), w) == gram
    place = np.flatnonzero(chosen)
    return place, gram[place]


def _words(raw: np.ndarray, offsets: np.ndarray):
    low = _LOWER[raw]
    start, end, row, _ = token_runs(low, offsets, _CLASSES)
    return low, start, end, row


def _fingerprints(spans: list[int], whole: int | None = None):
    """Rows (key columns..., span, place, fp) of texts. For items ``whole`` is the span asked for: items of
    fewer words have a span of their length alone."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part, own in text_steps(batch.column(batch.num_columns - 1), STEP_BYTES):
                low, start, end, row = _words(part, own)
                first = np.searchsorted(row, np.arange(b - a))
                n_words = np.bincount(row, minlength=b - a)
                h = run_hashes(low, start, end - start)
                for span in spans:
                    place, fp = winnow(h, row, span)
                    if whole is not None and span < whole:
                        use = n_words[row[place]] == span
                        place, fp = place[use], fp[use]
                    of = row[place]
                    keys = [batch.column(c).slice(a, b - a).take(pa.array(of)) for c in range(batch.num_columns - 1)]
                    yield pa.RecordBatch.from_arrays(
                        [*keys, pa.array(np.full(len(of), span, np.int32)), pa.array((place - first[of]).astype(np.int32)), pa.array(fp.view(np.int64))],
                        [*batch.schema.names[:-1], "span", "place", "fp"])

    return emit


def _windows(of_hits: bool, span: int):
    """Rows (key columns..., start, size, window) of texts: all windows of items (last columns: text),
    or the windows of documents around hits (last columns: hits as arrays of (span, place), text)."""
    word = re.compile(WORD)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.num_columns - (2 if of_hits else 1)
            which, starts, sizes, windows = [], [], [], []

            def out():
                return pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(which, pa.int64())) for c in range(keys)), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(windows, pa.binary())],
                    [*batch.schema.names[:keys], "start", "size", "window"])

            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                words = word.findall((text.as_py() or "").encode().lower())
                if of_hits:
                    todo = set()
                    for hit in batch.column(keys)[i].as_py():
                        s = hit["span"]
                        k, _ = gram_sizes(s)
                        todo.update((x, s) for x in range(max(0, hit["place"] + k - s), min(hit["place"], len(words) - s) + 1))
                else:
                    s = min(span, len(words))
                    todo = {(x, s) for x in range(len(words) - s + 1)} if s else set()
                for x, s in sorted(todo):
                    which.append(i), starts.append(x), sizes.append(s), windows.append(b" ".join(words[x:x + s]))
                if len(which) >= 50_000:
                    yield out()
                    which, starts, sizes, windows = [], [], [], []
            yield out()

    return emit


def _places(docs: DataFrame, items: DataFrame, id_col: str, item_col: str, text_col: str, span: int) -> tuple[DataFrame, DataFrame]:
    """(doc, hash, start, size, window) of documents' windows that occur in items, and the written
    rows (window, size, item): one for each item that holds a window."""
    plain = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    bench = written(plain.mapInArrow(_windows(False, span), "item string, start int, size int, window binary")
                    .select("window", "size", "item").distinct(), "item-windows")
    spans = sorted({r["size"] for r in bench.select("size").distinct().collect()})  # at most `span` numbers
    if not spans:
        spans = [span]
    fps = written(plain.mapInArrow(_fingerprints(spans, span), "item string, span int, place int, fp long")
                  .select("span", "fp").distinct(), "item-fingerprints")
    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    emitted = texts.mapInArrow(_fingerprints(spans), f"doc {id_type}, hash long, span int, place int, fp long")
    hits = written(emitted.join(fps, ["span", "fp"], "left_semi").groupBy("doc", "hash")
                   .agg(F.collect_set(F.struct("span", "place")).alias("hits")), "hits")
    around = (texts.join(hits.withColumnsRenamed({"doc": "d", "hash": "h"}), F.col("doc").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h")))
              .select("doc", "hash", "hits", "text")
              .mapInArrow(_windows(True, span), f"doc {id_type}, hash long, start int, size int, window binary"))
    return around.join(bench, ["window", "size"], "left_semi").select("doc", "hash", "start", "size", "window"), bench


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
            text_col: str = "text", span: int = SPAN) -> DataFrame:
    """(doc, hash, start, size, item): the windows of documents that occur in items, a row for each item.

    A window is ``span`` consecutive words of an item, or all words of a shorter one. ``hash`` is
    xxhash64 of the document's text, so rows that share an id keep apart; ``item`` is an item's id
    as a string. Items without an id or without words match nothing.
    """
    found, bench = _places(docs, items, id_col, item_col, text_col, span)
    return found.join(bench, ["window", "size"]).select("doc", "hash", "start", "size", "item")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
                  text_col: str = "text", span: int = SPAN) -> DataFrame:
    """(id, n_words, n_hit, items) for each row of ``docs``: its words, those inside any matched
    window, and the sorted ids of the items that match. Null and empty texts have no words.

    A document's items are counted as rows (document, item) of its distinct windows, so a window that very
    many items share makes many short rows; only the result holds them as one list per document.
    """
    found, bench = _places(docs, items, id_col, item_col, text_col, span)
    found = written(found.distinct(), "places")
    words = found.groupBy("doc", "hash").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("size") - 1))))).cast("long").alias("n_hit"))
    held = (found.select(F.col("doc").alias("i"), F.col("hash").alias("g"), "window", "size").distinct().join(bench, ["window", "size"])
            .select("i", "g", "item").distinct().groupBy("i", "g").agg(F.array_sort(F.collect_list("item")).alias("items")))
    per_doc = words.join(held, F.col("doc").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("g")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            for a, b, part, own in text_steps(batch.column(2), STEP_BYTES):
                n_words[a:b] = np.bincount(_words(part, own)[3], minlength=b - a)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words)], ["d", "h", "n_words"])

    rows = docs.select(F.col(id_col).alias("d"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")).mapInArrow(
        count, f"d {docs.schema[id_col].dataType.simpleString()}, h long, n_words long")
    joined = rows.join(per_doc, F.col("d").eqNullSafe(F.col("doc")) & (F.col("h") == F.col("hash")), "left")
    return joined.select(F.col("d").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
                         text_col: str = "text", span: int = SPAN) -> DataFrame:
    """``docs`` without the rows in whose text a benchmark window occurs. All columns stay as they are."""
    bad = _places(docs, items, id_col, item_col, text_col, span)[0].select("doc", "hash").distinct()
    rows = docs.select(F.col(f"`{id_col}`").alias("d"), F.xxhash64(text_col).alias("h"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = rows.join(bad, rows["d"].eqNullSafe(bad["doc"]) & (rows["h"] == bad["hash"]), "left_anti")
    return left.select("row.*")

"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius; fingerprints within the
radius meet at a variant in the middle. A variant's bucket is at most one ball of fingerprints
(65 for radius 2), whatever the data, so no bucket can become large: exact copies, however many,
are one fingerprint before the variants are made.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.llm.common import give_back, written
from strataframe.llm.components import components

SEED = 42


def shingle_hashes(text: str, width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``width`` words (fewer words: of the whole sequence)."""
    words = text.encode().lower().split()  # bytes: lower-cases A-Z only, splits at ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist(), strict=True)
    return np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes; 0 without hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        part = hashes[k:k + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint_bits",
                     width: int = 3, seed: int = SEED) -> DataFrame:
    """``docs`` with a bigint column of the fingerprint's 64 bits. Null and empty texts: 0."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])
    place = docs.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(shingle_hashes(t.as_py() or "", width, seed)) for t in batch.column(place)]
            column = pa.array(np.array(bits, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, out])
            give_back()

    return docs.mapInArrow(add, schema)


def ball_masks(radius: int) -> list[int]:
    """All 64-bit masks of at most ``radius`` bits, as signed integers."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fingerprints: DataFrame, radius: int) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints ``fp``, enough to connect all that lie
    within ``radius`` bits.

    With an even radius any two members of a bucket are within the radius of each other, so a
    link from each member to the bucket's least one loses no connection. With an odd radius the
    bucket's pairs are compared (a bucket is at most one ball).
    """
    spread = F.explode(F.array(*[F.lit(m).cast("long") for m in ball_masks((radius + 1) // 2)]))
    emitted = fingerprints.select("fp", spread.alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    if radius % 2 == 0:
        hub = F.min("fp").over(Window.partitionBy("variant"))
        found = emitted.select(F.col("fp").alias("a"), hub.alias("b")).where("a <> b")
    else:
        other = emitted.select(F.col("fp").alias("b"), "variant")
        found = emitted.withColumnRenamed("fp", "a").join(other, "variant").where("a > b").select("a", "b")
    return found.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def _linked(rows: DataFrame, least: Column, radius: int) -> DataFrame:
    """(fp, least, root) of the distinct fingerprints of ``rows``: ``least`` is aggregated for each, ``root`` names
    the component."""
    classes = written(rows.groupBy("fp").agg(least.alias("least")), "classes")
    roots = components(links(classes.select("fp"), radius))
    return classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    radius: int = 2, seed: int = SEED) -> DataFrame:
    """(id, fingerprint_bits, component_id) for each row.

    component_id is the smallest id among all rows that are reachable over links of at most
    ``radius`` differing bits (the row itself included). Null or empty texts have fingerprint 0
    and link like any other; rows that repeat an id stay rows of their own; a null id never is a
    component_id unless its whole component has no other. Columns of other names are not looked at.
    """
    rows = written(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                                    "text", "fp", width, seed).select("id", "fp"), "fingerprints")
    linked = _linked(rows, F.min("id"), radius)
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint_bits"),
                                         "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_apart: bool = False, **params) -> DataFrame:
    """``docs`` with one document of each near-duplicate component: that of the smallest id.

    Rows that repeat the kept id count as copies too, one of them stays. With ``rows_apart``, rows that
    share an id but not a text are documents of their own: of each component the row of the smallest id
    stays, and among its texts that of the least hash. A row without an id can't be named by a decision and stays.
    """
    keys = ["k", "h"] if rows_apart else ["k"]
    if rows_apart:
        kept = _least_rows(docs, id_col, text_col, **params)
    else:
        found = near_duplicates(docs, id_col, text_col, **params)
        kept = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("k")).distinct()
    rows = docs.select(F.col(id_col).alias("k"), F.xxhash64(text_col).alias("h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    first = (rows.where("k is not null").join(kept, keys, "left_semi")
             .groupBy(*keys).agg(F.min_by("row", F.xxhash64(f"row.`{text_col}`")).alias("row")))
    return first.select("row.*").unionByName(rows.where("k is null").select("row.*"))


def _least_rows(docs: DataFrame, id_col: str, text_col: str, width: int = 3, radius: int = 2, seed: int = SEED) -> DataFrame:
    """(k, h): id and text hash of the least row with an id of each component."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    rows = written(with_fingerprint(texts, "text", "fp", width, seed).select("id", "h", "fp"), "fingerprints")
    linked = _linked(rows, F.min(F.when(F.col("id").isNotNull(), F.struct("id", "h"))), radius)
    return linked.groupBy("root").agg(F.min("least").alias("least")).where("least is not null").select(
        F.col("least.id").alias("k"), F.col("least.h").alias("h"))

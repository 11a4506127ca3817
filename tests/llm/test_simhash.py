import re

import corpus_pipeline
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataframe.llm import simhash
from strataframe.llm.components import components
from tests.conftest import SF001
from tests.llm.helpers import ODD, clashing, documents


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(rows):
    least = {k: i for k, (i, _) in enumerate(rows)}
    prints = [plain_fingerprint(t) for _, t in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (prints[a] ^ prints[b]).bit_count() <= 2:
                    known = [x for x in (least[a], least[b]) if x is not None]
                    if known and (least[a] != min(known)):
                        least[a], changed = min(known), True
    return [(i, f"{p:016x}", least[k]) for k, ((i, _), p) in enumerate(zip(rows, prints, strict=True))]


def key(x):
    return tuple((v is None, v) for v in x)


@given(st.text(max_size=200))
@settings(max_examples=100, deadline=None)
def test_fingerprint_of_any_text(text):
    assert simhash.fingerprint(simhash.shingle_hashes(text, 3)) == plain_fingerprint(text)


def test_components_of_odd_rows(spark):
    near = [(100 + k, " ".join(["same"] * 60 + ["w%d" % k])) for k in range(6)]
    rows = ODD + near + [(200, near[0][1])]
    found = simhash.near_duplicates(clashing(documents(spark, rows))).collect()
    got = [(r.doc_id, f"{r.fingerprint_bits % (1 << 64):016x}", r.component_id) for r in found]
    assert sorted(got, key=key) == sorted(plain_components(rows), key=key)


def test_keep_one_keeps_columns_and_one_of_each_group(spark):
    docs = clashing(documents(spark, ODD))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in plain_components(ODD) if i is not None and i == c}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 2  # rows without an id stay


def test_rows_of_one_id_are_told_apart_by_text(spark):
    copy, alone = "a copy of the third document, word for word", "a text that stands for itself and is like no other"
    rows = [*ODD, (3000, copy), (3007, copy), (3007, alone), (3008, alone), (3009, "one"), (3009, "two"), (None, copy), (3010, "three"), (3010, "three")]
    groups = {}  # rows of a component: of the plain components of rows that each have an id of their own
    for (i, t), (_, _, c) in zip(rows, plain_components([(k, t) for k, (_, t) in enumerate(rows)]), strict=True):
        groups.setdefault(c, []).append((i, t))
    hashed = {r.text: r.h for r in documents(spark, rows).select("text", F.xxhash64("text").alias("h")).collect()}
    want = [min((r for r in group if r[0] is not None), key=lambda r: (r[0], hashed[r[1]])) for group in groups.values() if any(i is not None for i, _ in group)]
    docs = clashing(documents(spark, rows))
    for left in (simhash.keep_one(docs, rows_apart=True), corpus_pipeline.drop_near_copies(spark, docs, SF001)):
        assert left.columns == docs.columns
        got = [(r.doc_id, r.text) for r in left.collect()]
        assert sorted(got, key=repr) == sorted([*want, *(r for r in rows if r[0] is None)], key=repr)
        assert (3007, copy) not in got and (3007, alone) in got and (3000, copy) in got


def test_empty_table(spark):
    assert simhash.keep_one(documents(spark, []), rows_apart=True).count() == 0
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_links_find_each_connection_of_any_radius(spark):
    base = 0x0123456789ABCDEF
    prints = [base, base ^ 1, base ^ 3, base ^ 0b111, base ^ (1 << 63), base ^ 0b11111000, 0]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    for radius in (1, 2, 3):
        roots = {p: p for p in signed}
        for a in signed:
            for b in signed:
                if ((a ^ b) % (1 << 64)).bit_count() <= radius:
                    low = min(roots[a], roots[b])
                    roots = {p: low if r in (roots[a], roots[b]) else r for p, r in roots.items()}
        found = {r.node: r.root for r in components(simhash.links(table, radius)).collect()}
        assert {p: found.get(p, p) for p in signed} == roots


def test_components_of_paths_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(200 + k, 200 + (k + 1) % 9) for k in range(9)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, **{k: 200 for k in range(200, 209)}}

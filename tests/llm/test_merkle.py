import hashlib
import zlib

import pytest
from helpers import ODD, clashing, documents
from pyspark.sql import functions as F

from strataframe.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def up(nodes, fan):
    """Root, and each node's siblings by level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        for i, p in enumerate(place):
            run = runs[p // fan]
            paths[i].append(("".join(run[:p % fan]), "".join(run[p % fan + 1:])))
        place, nodes = [p // fan for p in place], [h(*run) for run in runs]
    return nodes[0], paths


def plain(rows, fan):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    subs, out = {}, []
    for source, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[source] = up([leaf(r) for r in own], fan)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    root, tops = up([subs[s][0] for s in order], fan)
    for s, top in zip(order, tops):
        for r, path in zip(by[s], subs[s][1]):
            claimed = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                claimed = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            folded = claimed
            for left, right in path + top:
                folded = h(left, folded, right)
            out.append((r[0], leaf(r), subs[s][0], root, h(*[x for p in path + top for x in p]), folded, folded == root))
    return sorted(out, key=str)


def got(df, fan):
    found = merkle.manifest(df, fan, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    return sorted((tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("fan, n, sources", [(16, 700, 3), (2, 45, 6), (3, 40, 30)])
def test_paths_and_roots_are_those_of_a_plain_tree(spark, fan, n, sources):
    """Half of the rows have one source; one source has one row."""
    rows = [(i, None if i % 11 == 7 else "hot" if i % 2 else f"s{i % sources}é", "en", i, f"Text {i}" if i % 3 else f"text {i}") for i in range(n)]
    rows += [(n, "alone", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert got(df, fan) == plain(rows, fan)


def test_odd_rows(spark):
    docs = clashing(documents(spark, ODD)).withColumn("place", F.lit(1)).withColumn("group", F.lit("x")).withColumn("size", F.lit(0))
    plain_rows = [(i, None, "en", None if t is None else len(t), t) for i, t in ODD]
    assert got(docs, 16) == plain(plain_rows, 16)


def test_one_row_is_its_own_root(spark):
    docs = documents(spark, [(3, "Only")])
    row = merkle.manifest(docs).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["path"] == [] and row["proof_sha256"] == h()


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "s", "en", 4, "Same")] * 37 + [(None, "s", "en", 4, "Same")] * 20 + [(1, "", "en", 4, "other")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert got(df, 16) == plain(rows, 16)
    assert got(df.limit(0), 16) == []


def test_any_change_shows(spark):
    """Every column of a leaf counts, and a null is no empty text."""
    rows = [(1, "s", "en", 4, "text"), (2, "s", "en", 4, ""), (3, "s", None, None, None)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    first = merkle.manifest(spark.createDataFrame(rows, schema)).first()["root"]
    for other in ([rows[0], rows[1], (3, "s", "", None, None)], [rows[0], (2, "s", "en", 4, None), rows[2]], rows[:2],
                  [(1, "s", "en", 5, "text"), *rows[1:]], [(1, "t", "en", 4, "text"), *rows[1:]]):
        assert merkle.manifest(spark.createDataFrame(other, schema)).first()["root"] != first

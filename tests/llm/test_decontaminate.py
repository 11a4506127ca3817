import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataframe.llm import decontaminate
from tests.llm.helpers import ODD, clashing, documents

ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item here"), (3, "x y"), (10, "short ITEM, here!"),
         (4, None), (5, ""), (6, "..."), (None, "plain words some of them twice plain words some"), (7, "é"), (8, "plain words some of them twice plain words some of"),
         (8, "plain words some of them twice plain words some of")]


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, span=10):
    windows = {}
    for i, t in items:
        w = words(t)
        s = min(span, len(w))
        for p in range(len(w) - s + 1 if s and i is not None else 0):
            windows.setdefault(tuple(w[p:p + s]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for s in {len(x) for x in windows}:
            for p in range(len(w) - s + 1):
                got = windows.get(tuple(w[p:p + s]))
                if got:
                    hit.update(range(p, p + s))
                    found |= got
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def key(x):
    return tuple((v is None, v) for v in x)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_odd_rows(spark):
    rows = ODD + [(70, "A short item, here; and one two three four five six seven eight nine ten"), (71, "x Y x y"), (72, "nine ten eleven twelve")]
    found = decontaminate.contamination(clashing(documents(spark, rows)), bench(spark, ITEMS)).collect()
    assert sorted((tuple(r) for r in found), key=key) == sorted(plain(rows, ITEMS), key=key)


def test_every_shared_span_is_found(spark):
    import random

    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(12)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.randint(3, 30))) for k in range(15)]
    rows = [(k, text(rng.randint(0, 60)) + " " + " ".join(items[k % 15][1].split()[:rng.randint(0, 14)]) + " " + text(5)) for k in range(60)]
    found = decontaminate.contamination(documents(spark, rows), bench(spark, items)).collect()
    assert sorted(tuple(r) for r in found) == sorted(plain(rows, items))


@pytest.mark.parametrize("span", [1, 4, 8, 13])
def test_spans_below_and_above_the_default(spark, span):
    import random

    rng = random.Random(span)
    vocabulary = [f"w{k}" for k in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [*ITEMS, *((100 + k, text(rng.randint(1, 30))) for k in range(15))]
    rows = [*ODD, *((100 + k, text(rng.randint(0, 20)) + " " + " ".join(items[-1 - k % 15][1].split()[:rng.randint(0, 18)]) + " " + text(5)) for k in range(60))]
    docs, table = documents(spark, rows), bench(spark, items)
    want = plain(rows, items, span)
    assert any(n for _, _, n, _ in want)
    assert sorted((tuple(r) for r in decontaminate.contamination(docs, table, span=span).collect()), key=key) == sorted(want, key=key)
    left = decontaminate.without_contaminated(docs, table, span=span)
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((i for i, _, n, _ in want if not n), key=repr)


def test_contaminated_documents_go(spark):
    docs = clashing(documents(spark, ODD))
    left = decontaminate.without_contaminated(docs, bench(spark, ITEMS))
    assert left.columns == docs.columns
    want = [i for i, _, n, _ in plain(ODD, ITEMS) if not n]
    assert sorted((r.doc_id for r in left.collect()), key=lambda i: (i is None, i)) == sorted(want, key=lambda i: (i is None, i))


def test_empty_tables(spark):
    docs, none = documents(spark, ODD), bench(spark, [])
    assert decontaminate.without_contaminated(docs, none).count() == len(ODD)
    assert {r.n_hit for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert decontaminate.contamination(documents(spark, []), bench(spark, ITEMS)).count() == 0


def test_an_instruction_that_many_items_share(spark):
    shared = "answer the question below with a single word and nothing else"
    items = [(k, f"{shared} item{k} tail{k}") for k in range(3000)]
    rows = [(1, f"{shared} item7 tail7"), (2, f"so {shared}"), (2, "clean text of the same id"), (None, shared), (3, "a clean text")]
    docs, table = documents(spark, rows), bench(spark, items)
    got = decontaminate.contamination(docs, table).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(plain(rows, items), key=key)
    found = decontaminate.matches(docs, table)
    assert dict(found.dtypes)["item"] == "string"
    assert found.where("doc = 2").select("item").distinct().count() == 3000


@given(st.lists(st.sampled_from("abcd"), max_size=60), st.integers(1, 12))
@settings(max_examples=150, deadline=None)
def test_each_window_holds_a_chosen_gram(letters, span):
    import numpy as np

    raw = np.frombuffer(" ".join(letters).encode() + bytes(8), np.uint8)
    offsets = np.array([0, len(raw) - 8])
    low, start, end, row = decontaminate._words(raw, offsets)
    place, _ = decontaminate.winnow(decontaminate.run_hashes(low, start, end - start), row, span)
    k, w = decontaminate.gram_sizes(span)
    for p in range(len(letters) - span + 1):
        assert ((place >= p) & (place < p + w)).any()

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataframe.llm import quality, queries, toxicity
from strataframe.llm.common import flat_text
from strataframe.llm.queries import QUERIES
from strataframe.sources.tables import load
from tests.conftest import SF01
from tests.llm.helpers import ODD, clashing, documents


def words_of(rng, n, pool):
    return " ".join(rng.choice(pool, n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    pool = ["the", "of", "and", "to", *(f"word{k}" for k in range(300))]
    rows, labels = [], []
    for k in range(600):
        toxic, junk = k % 4 == 0, k % 3 == 0
        text = words_of(rng, 80, pool).split()
        if toxic:
            text[int(rng.integers(0, 80))] = str(rng.choice(["vileword", "nastyword"]))
        if junk:
            text = [f"{w} {w} {w} {w} ###" for w in text[:20]] + (["vileword"] if toxic else [])
        rows.append((k, " ".join(text)))
        labels.append((k, 0 if junk else 1, int(toxic)))
    return rows, documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_words_are_found_wherever_they_stand(spark, labelled):
    rows, docs, labels = labelled
    model = toxicity.train(docs, labels, "toxic", F.col("doc_id") < 450, target=0.3)
    got = {r.doc_id: r.score for r in toxicity.with_score(docs, model).collect()}
    held = [k for k, _ in rows if k >= 450]
    assert np.mean([(got[k] >= 0.3) == (k % 4 == 0) for k in held]) > 0.95
    long = documents(spark, [(1, rows[1][1] * 300 + " vileword"), (2, rows[1][1] * 300)])
    late = {r.doc_id: r.score for r in toxicity.with_score(long, model).collect()}
    assert late[1] >= 0.3 > late[2]


def test_junk_is_found(labelled):
    rows, docs, labels = labelled
    model = quality.train(docs, labels, "quality", F.col("doc_id") < 450)
    got = {r.doc_id: r.score for r in quality.with_score(docs, model).collect()}
    held = [k for k, _ in rows if k >= 450]
    assert np.mean([(got[k] >= 0.5) == (k % 3 != 0) for k in held]) > 0.95


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows_and_no_labels(spark, module):
    docs = clashing(documents(spark, ODD)).drop("score")
    none = spark.createDataFrame([], "doc_id long, mark int")
    some = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (7, None), (99, 0)], "doc_id long, mark int")
    for labels in (none, some):
        scored = module.with_score(docs, module.train(docs, labels, "mark", F.lit(True)))
        rows = scored.collect()
        assert scored.columns == [*docs.columns, "score"] and len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    empty = documents(spark, [])
    assert module.with_score(empty, module.train(empty, none, "mark", F.lit(True))).count() == 0


def first_in_order(rows, words):
    """A text of so many words whose hash sorts before those of ``rows``."""
    hashed = lambda texts: toxicity.run_hashes(*(lambda raw, at: (raw, at[:-1], np.diff(at)))(*flat_text(pa.array(texts)))).view(np.int64)
    least = hashed([t for _, t in rows]).min()
    for k in range(0, 1 << 16, 512):
        found = [f"long{j} " + "word1 " * (words - 1) for j in range(k, k + 512)]
        if (at := hashed(found)).min() < least:
            return found[int(at.argmin())]
    raise AssertionError


def test_an_overlong_first_text_leaves_the_others_to_learn_from(spark, labelled, monkeypatch):
    rows, _, _ = labelled
    budget = 20_000
    long = first_in_order(rows, budget + 1)
    docs = documents(spark, [*rows, (1000, long)])
    labels = spark.createDataFrame([*((k, int(k % 4 == 0)) for k, _ in rows), (1000, 0)], "doc_id long, toxic int")
    monkeypatch.setattr(queries, "toxicity_model", lambda spark, sf_dir, docs: toxicity.train(
        docs, labels, "toxic", F.lit(True), target=queries.TOXIC_SCORE, words=budget))
    left = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF01).collect()}
    assert np.mean([(k in left) == (k % 4 != 0) for k, _ in rows]) > 0.95 and 1000 in left


@pytest.mark.parametrize("marks", [[], [(k, 0) for k in range(1, 40)]])
def test_no_positives_drop_nothing(spark, tmp_path, marks):
    spark.createDataFrame(marks, "doc_id long, toxic int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(spark, ODD)
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == len(ODD)
    model = queries.toxicity_model(spark, str(tmp_path), docs)
    assert all(r.score < queries.TOXIC_SCORE for r in toxicity.with_score(docs, model).collect())


def test_pooling_is_the_plain_maximum():
    model = toxicity.Convolution.start(1)
    rng = np.random.default_rng(2)
    sizes = [0, 1, 2, 5, 0, 3, 1, 0]
    rows = rng.integers(0, 1 << toxicity.TABLE_BITS, (sum(sizes), 3))
    before = np.append(0, np.cumsum(sizes))
    got, _ = model.pooled(rows, before)
    for t in range(len(sizes)):
        words = model.table[rows[before[t]:before[t + 1]]].sum(1)
        for k, (width, filt) in enumerate(zip(toxicity.WIDTHS, model.filters, strict=True)):
            seen = [sum(words[p + j] @ filt[j] for j in range(width)) for p in range(len(words) - width + 1)]
            want = np.max(seen, axis=0) if seen else np.zeros(toxicity.FILTERS)
            assert np.allclose(got[t, k * toxicity.FILTERS:(k + 1) * toxicity.FILTERS], want, atol=1e-5)


def test_contexts_are_counted_over_all_documents(spark):
    rows = [(1, "a b c"), (2, "a b"), (3, None), (4, "b"), (5, "x, x")]
    got = quality.corpus_contexts(documents(spark, rows).repartition(3))
    index = quality.index_vectors()
    dense = np.zeros((1 << quality.BUCKET_BITS, quality.DIM))
    np.put_along_axis(dense, index[0], index[1].astype(float), 1)
    of = lambda w: int(quality.buckets(np.frombuffer(w.encode() + bytes(8), np.uint8), np.array([0, len(w)]))[0][0])
    a, b, c = of("a"), of("b"), of("c")
    assert (got[a] == 2 * dense[b] + dense[c]).all() and (got[c] == dense[a] + dense[b]).all()


@pytest.mark.parametrize(("name", "column", "label", "least"), [("op5_quality", "quality", 1, 0.97), ("op10_toxicity", "toxic", 1, 0.85)])
def test_held_out_accuracy(spark, name, column, label, least):
    rows = {r.doc_id: r for r in QUERIES[name](spark, SF01).collect()}
    truth = [(r.doc_id, r[column]) for r in load(spark, SF01, "labels").collect() if rows[r.doc_id].held_out]
    assert np.mean([rows[i].predicted == v for i, v in truth]) >= least


def test_repeated_labelled_ids_are_one_row(spark, monkeypatch):
    """One labelled id on most rows: one vector of it reaches the driver, whichever task finds it."""
    rows = [(1, f"text number {k}") for k in range(3000)] + [(2, "other words"), (2, "other words"), (3, None), (4, "unlabelled"), (None, "none")]
    marks = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (9, 1), (None, 1)], "doc_id long, quality int")
    seen = []
    usual = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y, seed: seen.append((x.copy(), y.tolist())) or usual(x, y, seed))
    for parts in (1, 5):
        quality.train(documents(spark, rows).repartition(parts), marks, "quality", F.lit(True))
    assert sorted(seen[0][1]) == [0, 0, 1] and seen[0][1] == seen[1][1] and (seen[0][0] == seen[1][0]).all()


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word that only the last rows in hash order hold, behind 5,000 others of their label, is learnt."""
    order = [r.doc_id for r in spark.range(8000).toDF("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    rng = np.random.default_rng(3)
    pool = [f"word{k}" for k in range(50)]
    text = lambda *own: " ".join([*rng.choice(pool, 6), *own])
    rows = [(i, text("vileword" if k < 5000 else "latebad") if k < 6000 else text()) for k, i in enumerate(order)]
    labels = spark.createDataFrame([(i, int(k < 6000)) for k, i in enumerate(order)], "doc_id long, toxic int")
    model = toxicity.train(documents(spark, rows), labels, "toxic", F.lit(True))
    new = documents(spark, [*((k, text("latebad")) for k in range(100)), *((k, text()) for k in range(100, 200))])
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.with_score(new, model).collect()}
    assert np.mean([got[k] == (k < 100) for k in got]) > 0.95


def test_toxicity_has_one_model_whatever_the_layout(spark, labelled):
    rows, docs, labels = labelled
    models = [toxicity.train(docs.repartition(parts), labels, "toxic", F.lit(True), words=15_000) for parts in (1, 5)]
    for name in ("table", "bias", "dense", "thresholds"):
        assert (getattr(models[0], name) == getattr(models[1], name)).all()


def test_a_round_is_the_mean_of_what_the_parts_moved(spark):
    rng = np.random.default_rng(4)
    sizes = rng.integers(0, 12, 90)
    words = [rng.integers(0, 400, (n, 3)).astype("<u2") for n in sizes]
    label, part = rng.integers(0, 2, 90), np.sort(rng.integers(0, 3, 90))
    dealt = spark.createDataFrame([(int(p), False, k, int(y), 0, int(n), w.tobytes()) for k, (p, y, n, w) in enumerate(zip(part, label, sizes, words, strict=True))],
                                  "part int, tune boolean, deal long, label int, language int, n long, words binary").repartitionById(3, F.col("part"))
    state = toxicity.start_state(1)
    sums = np.full_like(state, 1e-8)
    total, weight = np.zeros((len(state), 2 * toxicity.DIM)), np.zeros((len(state), 1))
    for p in range(3):
        use = np.flatnonzero(part == p)
        new, squares = toxicity.learn(state, sums, np.concatenate([words[k] for k in use]), np.append(0, np.cumsum(sizes[use])),
                                      label[use].astype(np.float32), 2, [7, p])
        change = np.concatenate([new - state, squares - sums], 1)
        weight[change.any(1)] += len(use)
        total += len(use) * change
    want = np.concatenate([state, sums], 1) + total / np.maximum(weight, 1)
    toxicity._one_round(dealt.sortWithinPartitions("part", "deal"), state, sums, 2, 10_000, 7)
    assert (weight[:400] > 0).mean() > 0.5 and np.allclose(np.concatenate([state, sums], 1), want, atol=1e-6)


def test_thresholds_miss_least():
    rng = np.random.default_rng(5)
    counts = np.zeros((len(toxicity.LANGUAGES), 2 * toxicity.GREATEST * toxicity.GRID + 1, 2), np.int64)
    for lang, n in ((0, 400), (1, 60), (2, 5)):  # the last has too few rows of its own
        for y in (0, 1):
            z = np.rint(rng.normal(y * 2 + lang, 1, n) * toxicity.GRID).astype(int) + toxicity.GREATEST * toxicity.GRID
            np.add.at(counts[lang, :, y], z, 1)
    got = toxicity.thresholds(counts)
    steps = (np.arange(counts.shape[1]) - toxicity.GREATEST * toxicity.GRID) / toxicity.GRID
    cost = lambda c, t: c[steps < t, 1].sum() / c[:, 1].sum() + c[steps >= t, 0].sum() / c[:, 0].sum()
    for lang, c in ((0, counts[0]), (1, counts[1]), (2, counts.sum(0))):
        assert cost(c, got[lang]) <= min(cost(c, t) for t in steps[::4]) + 1e-12

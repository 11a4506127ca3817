import os

import corpus_pipeline
from pyspark.sql import functions as F

from strataframe.llm import packing, queries, suffixes, toxicity
from strataframe.llm.common import written
from strataframe.session import checkpoint_dir
from strataframe.sources.tables import load
from tests.conftest import SF001
from tests.llm import test_decontaminate, test_simhash, test_suffixes
from tests.llm.helpers import EXTRA, ODD, PASSAGE, documents


def test_stages_against_plain_versions(spark):
    docs = load(spark, SF001, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and "near_dedup" in names[1]
    model = queries.toxicity_model(spark, SF001, docs)
    calm = {r.doc_id for r in toxicity.with_score(docs, model).where(F.col("score") < 0.3).collect()}
    now = written(corpus_pipeline.STAGES[0][1](spark, docs, SF001), "t")
    assert now.columns == docs.columns and {r.doc_id for r in now.collect()} == calm

    rows = [(r.doc_id, r.text) for r in now.collect()]
    now = written(corpus_pipeline.STAGES[1][1](spark, now, SF001), "t")
    assert {r.doc_id for r in now.collect()} == {i for i, _, c in test_simhash.plain_components(rows) if i == c}

    rows = [(r.doc_id, r.text) for r in now.collect()]
    now = written(corpus_pipeline.STAGES[2][1](spark, now, SF001), "t")
    got = {r.doc_id: r.text for r in now.collect()}
    for i, data, mask in test_suffixes.plain_masks(rows, 50):
        kept = bytes(b for b, m in zip(data, mask, strict=True) if not m).decode(errors="ignore")
        assert (i not in got) if not kept and data and all(mask) else len(got[i]) - len(kept) in range(0, 1 + 2 * sum(mask))
        if not any(mask):
            assert got[i].encode() == data

    items = [(r.item_id, r.text) for r in load(spark, SF001, "benchmark").collect()]
    rows = [(r.doc_id, r.text) for r in now.collect()]
    now = written(corpus_pipeline.STAGES[3][1](spark, now, SF001), "t")
    assert {r.doc_id for r in now.collect()} == {i for i, _, n, _ in test_decontaminate.plain(rows, items) if not n}

    packed = corpus_pipeline.STAGES[4][1](spark, now, SF001)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in now.collect()}


def test_only_the_last_result_is_left_in_the_shared_folder(spark):
    folder = checkpoint_dir(spark)
    before = set(os.listdir(folder))
    packed = corpus_pipeline.run(spark, SF001)
    left = sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before)
    assert packed.count() > 0
    assert [n for n in left if n.startswith("stage-")] == ["stage-benchmark_decontamination"]
    assert not set(left) & {"classes", "fingerprints", "large-star", "labelled", "places", "hits"}


def test_stages_take_odd_rows_and_empty_tables(spark):
    odd = documents(spark, ODD + [(80, "Something else. " + PASSAGE)]).select("*", *[F.lit(1).alias(c) for c in EXTRA])
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs, before = written(stage(spark, docs, SF001), "t"), docs
            assert docs.columns == before.columns and docs.count() <= before.count()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
        assert last.count() >= docs.count()
    assert packing.CAPACITY == 4096 and suffixes.LENGTH == 50

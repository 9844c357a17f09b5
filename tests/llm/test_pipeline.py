"""The pipeline's stages, each against plain code on its own input."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
import pytest
from test_allocation import check_packs, plain_targets
from test_row_operators import plain_measure, plain_spans
from test_text_matching import plain_components, plain_sets

from millrace.llm import mixing
from millrace.llm.common import settle


@pytest.fixture(scope="module")
def stages(spark):
    """The input of each stage and the result of the last."""
    at = "/root/testdata/sf0.001"
    out = [spark.read.parquet(f"{at}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], at), name.replace(" ", "_")))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "secret scan", "mixing", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality_stage(stages):
    good = set()
    for r in stages[0].collect():
        m = plain_measure(r["text"])
        if m[0] >= 50 and 100 * m[4] <= 50 * m[0]:
            good.add(tuple(r))
    assert {tuple(r) for r in stages[1].collect()} == good  # no host of this table is rejected


def test_near_duplicate_stage(stages):
    rows = stages[1].collect()
    roots = plain_components(plain_sets([(r["doc_id"], r["text"]) for r in rows], 5), 80)
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(i for i, r in roots.items() if i == r)


def test_secret_stage(stages):
    before = {r["doc_id"]: r for r in stages[2].collect()}
    after = {r["doc_id"]: r for r in stages[3].collect()}
    assert set(before) == set(after)
    for i, r in before.items():
        assert not plain_spans(after[i]["text"]) and (("[secret]" in after[i]["text"]) >= bool(plain_spans(r["text"])))
        if "[secret]" not in after[i]["text"]:
            assert after[i] == r


def test_mixing_stage(stages):
    sums, took = defaultdict(int), defaultdict(int)
    for r in stages[3].collect():
        sums[r["source"]] += len(r["text"].encode().split())
    for r in stages[4].collect():
        took[r["source"]] += len(r["text"].encode().split())
    names = sorted(sums)
    goals = dict(zip(names, plain_targets([sums[s] for s in names]), strict=True))
    assert dict(took) == pytest.approx(goals, rel=0.01, abs=1.5 * mixing.BLOCK)  # rounding, and a short last block


def test_packing_stage(stages):
    assert check_packs(stages[5].collect(), [(r["doc_id"], r["text"]) for r in stages[4].collect()]) > 0.95


def test_run_and_edges(spark, docs, empty, stages, tmp_path):
    """run() gives what the stages give; of a table of edges each document that is kept is packed whole, as often as it is taken."""
    assert sorted(map(tuple, corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect())) == sorted(map(tuple, stages[5].collect()))
    docs.write.parquet(str(tmp_path / "some" / "documents.parquet"))
    out = [spark.read.parquet(str(tmp_path / "some" / "documents.parquet"))]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], str(tmp_path / "some")), name.replace(" ", "_")))
        assert out[-1].columns == docs.columns or name == "packing"
    ids = [sorted({r["doc_id"] for r in x.select("doc_id").collect()}, key=lambda i: (i is None, i or 0)) for x in out]
    assert ids[1] == [-5, 1, 2, 9, 10, 11, 13, 14, None]  # too short or repetitive ones go, and those of the null source, of which two in three fail
    assert ids[2] == ids[3] == [-5, 9, 10, 11, 13, 14, None]
    assert set(ids[4]) <= set(ids[3])
    assert check_packs(out[5].collect(), [(r["doc_id"], r["text"]) for r in out[4].collect()]) > 0
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path / "some")).select("doc_id", "length").collect()), key=str) == sorted(map(tuple, out[5].select("doc_id", "length").collect()), key=str)
    empty.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    none = corpus_pipeline.run(spark, str(tmp_path / "none"))
    assert none.count() == 0 and none.columns == out[5].columns

"""The corpus pipeline, each stage on its own input against a plain re-computation."""

import re

import pytest

import corpus_pipeline

from . import brute


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Rows before and after each stage, with the columns it returned; one document has an odd place in the corpus."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [(10_001, None, "en", "s", 0), (10_002, "", "en", "s", 0), (None, "plain words without an id", "en", "s", 25)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).unionByName(docs.where("doc_id = 5"))
    out, root = {}, tmp_path_factory.mktemp("pipeline")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out[name] = before, docs.collect(), docs.columns
    return out


def ids(rows):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in rows)


def test_stages_in_order_keep_the_columns_of_documents(stages):
    assert list(stages) == ["toxicity", "quality", "near_duplicates", "decontamination", "packing"]
    for name in list(stages)[:-1]:
        before, after, columns = stages[name]
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < len(after) <= len(before) and set(map(tuple, after)) <= set(map(tuple, before))


@pytest.mark.parametrize(("name", "label", "bad"), [("toxicity", "toxic", 1), ("quality", "quality", 0)])
def test_classifying_stages_keep_clean_documents(spark, sf_dir, stages, name, label, bad):
    before, after, _ = stages[name]
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    clean = [r.doc_id in kept for r in before if labels.get(r.doc_id) == 1 - bad]
    assert sum(clean) >= 0.97 * len(clean)


def test_one_near_duplicate_of_each_group_stays(stages):
    before, after, _ = stages["near_duplicates"]
    named = {r.doc_id: r.text for r in before if r.doc_id is not None}
    found = brute.jaccard(list(named.items()), size=5, percent=80)
    wanted = sorted(i for i, (_, component, _) in found.items() if component == i)
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == wanted
    assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before)


def test_contaminated_documents_go_and_others_stay_as_they_are(spark, sf_dir, stages):
    before, after, _ = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute.contaminated([(i, r.text) for i, r in enumerate(before)], items)
    assert ids(after) == ids([r for i, r in enumerate(before) if not found[i][4]])


def test_packing_holds_every_id_of_what_is_left(stages):
    before, after, _ = stages["packing"]
    total = sum(len(x) for x in brute.encoded([r.text for r in before]))
    assert sum(p.length for p in after) == total
    assert {p.doc_id for p in after} == {r.doc_id for r in before}
    sequences = {}
    for p in after:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= total / 2048 * 1.02 + 2


def test_run_is_the_registered_query():
    assert corpus_pipeline.ORACLE_SQL is None and re.fullmatch(r"[a-z]+", corpus_pipeline.run.__name__)

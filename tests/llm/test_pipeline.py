"""The pipeline: stages in order, columns kept, and each stage against brute force on its own input."""

import corpus_pipeline
from playlens.llm import common as C
from tests.llm.test_documents import WORD, fingerprint_by_force, leaks_by_force
from tests.llm.test_repeats import passages_by_force


def test_stages_take_effect(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "simhash near-dedup", "substring dedup", "benchmark decontamination", "byte-level BPE"]
    docs = C.read_documents(spark, sf_dir)
    inputs, outputs = [], []
    for _, stage in corpus_pipeline.STAGES:
        inputs.append({r.doc_id: r for r in docs.collect()})
        columns = docs.columns
        docs = C.cut(stage(spark, docs, sf_dir))
        outputs.append({r.doc_id: r for r in docs.collect()})
        assert docs.columns == columns or stage is corpus_pipeline.token_ids
    rows = [[(i, r.text) for i, r in sorted(x.items())] for x in inputs]

    assert outputs[0].keys() < inputs[0].keys()
    prints = {i: fingerprint_by_force(t) for i, t in rows[1]}
    kept = []
    for i in sorted(prints):                      # components on this input are pairs and stars of small ids
        if all((prints[i] ^ prints[k]).bit_count() > 2 for k in kept):
            kept.append(i)
    assert set(outputs[1]) <= set(kept)
    assert all(any((prints[i] ^ prints[k]).bit_count() <= 2 for k in prints if k < i) for i in set(prints) - set(outputs[1]))

    for i, n, gone, _ in passages_by_force(rows[2]):
        left = WORD.findall(outputs[2][i].text or "")
        assert len(left) == n - gone
        assert gone or outputs[2][i] == inputs[2][i]

    items = [(r.item_id, r.text) for r in C.read_documents(spark, sf_dir, "benchmark").collect()]
    short = [(i, t) for i, t in rows[3] if len(t) < 4000]          # brute force is quadratic
    hit = {d for d, *_ in leaks_by_force(short, items)}
    assert all((i in outputs[3]) == (i not in hit) for i, _ in short)

    assert all(outputs[4][i].decoded == t for i, t in rows[4])
    assert set(outputs[4]) == set(outputs[3])
    assert corpus_pipeline.run(spark, sf_dir).count() == len(outputs[4])


def test_stages_take_empty_documents(spark, sf_dir):
    docs = C.read_documents(spark, sf_dir).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = C.cut(stage(spark, docs, sf_dir))
        assert docs.count() == 0


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "op9_quality_rules" in __spark_entry__.oracle_sql()

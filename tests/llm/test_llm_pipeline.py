"""The pipeline's stages on the documents table."""

from collections import Counter

import pytest

import corpus_pipeline
from lodestone.llm import language, mixing, near_duplicates, secrets


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{tmp_path_factory.mktemp(name)}/t"
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "secret_scan", "source_mix", "best_fit_packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_each_stage_does_its_work(stages):
    docs, known, once, clean, mixed, packed = stages
    model = language.fit(docs)
    rows = docs.collect()
    langs, scores = language.predict([r["text"] for r in rows], model)
    assert {r["doc_id"] for r in known.collect()} == {r["doc_id"] for r, lang, s in zip(rows, langs, scores, strict=True) if lang != "und" and s >= model.threshold}
    named = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(known).collect()}
    assert {r["doc_id"] for r in once.collect()} == set(named.values())
    assert clean.count() == once.count()
    texts = [r["text"] for r in clean.collect()]
    assert not any(s for spans in secrets.scan(texts, secrets.VOCABULARY, 20, 2.2) for s in spans)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_report(clean).collect() if r["size"]}
    sizes = {r["doc_id"]: r["size"] for r in mixing.mix_report(clean).collect()}
    n = Counter(r["doc_id"] for r in mixed.collect())
    assert all(n[d] * sizes[d] == t for d, t in taken.items())
    tokens = Counter()
    for r in packed.collect():
        tokens[r["doc_id"]] += r["n_tokens"]
    assert tokens == Counter({d: k * (sizes[d] + 1) for d, k in n.items()})


def test_run_equals_the_stages(spark, sf_dir, stages):
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == Counter(map(tuple, stages[-1].collect()))


def test_no_rows(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []

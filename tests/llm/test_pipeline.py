"""The pipeline's stages against brute force over the smallest table, and its bare edges."""

import pytest

import corpus_pipeline
from reportlake.llm import decontaminate, tokens
from tests_llm_helpers import shingle_components


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    from reportlake.llm.shared import written

    docs, out = spark.read.parquet(f"{sf_small}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = written(stage(spark, docs, sf_small), "test-stage")
    return [*out, docs]


def rows(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_columns_and_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "near-duplicates", "decontamination", "secret scan", "packing"]
    assert all(f.columns == stages[0].columns and [x.dataType for x in f.schema] == [x.dataType for x in stages[0].schema] for f in stages[:-1])


def test_language_stage_keeps_texts_with_letters(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert set(after) <= set(before)
    assert len(after) >= 0.97 * len(before)
    assert all(any(c.isalpha() for c in r["text"]) for r in after.values())


def test_one_document_of_each_group_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    least = shingle_components({i: r["text"] for i, r in before.items()})
    assert set(after) == {i for i in before if least[i] == i}
    assert all(after[i]["text"] == before[i]["text"] for i in after)


def test_benchmark_passages_go(spark, sf_small, stages):
    items = [decontaminate.normalise(r["text"]) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    windows = {tuple(w[j : j + min(10, len(w))]) for w in items if w for j in range(len(w) - min(10, len(w)) + 1)}
    sizes = {len(w) for w in windows}
    dirty = lambda t: any(tuple(w[j : j + n]) in windows for n in sizes for w in [decontaminate.normalise(t)] for j in range(len(w) - n + 1))
    before, after = rows(stages[2]), rows(stages[3])
    assert any(dirty(r["text"]) for r in before.values())
    assert not any(dirty(r["text"]) for r in after.values())
    for i, r in before.items():
        if not dirty(r["text"]):
            assert after[i] == r
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_secrets_are_replaced(stages):
    import re

    fixed = re.compile(r"AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}")
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    assert any(fixed.search(r["text"]) for r in before.values())
    assert not any(fixed.search(r["text"]) for r in after.values())
    clean = [i for i, r in before.items() if "[SECRET]" not in after[i]["text"]]
    assert len(clean) > 0.8 * len(before) and all(before[i]["text"] == after[i]["text"] for i in clean)


def test_every_token_is_packed(stages):
    coder = tokens.Encoder(tokens.public_file())
    want = {i: len(coder.tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in rows(stages[4]).items()}
    got = {r["doc_id"]: r["n"] for r in stages[5].groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert got == want


def test_run_is_the_stages(spark, sf_small, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_small).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, stages[5].select("doc_id", "start", "length", "ids_crc32").collect()))


def test_empty_table(spark, empty, sf_small):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small)
    assert docs.count() == 0

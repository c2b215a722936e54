"""The pipeline: each stage on what its predecessor kept."""

import re

import corpus_pipeline as pipeline
from tests.llm.test_ngram_join import brute
from tickloom.llm import decontamination

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "ngram_join", "decontamination", "pii", "packing"]
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs)
        if name != "packing":
            assert docs.columns == columns
    by_id = [{r.doc_id: r for r in df.collect()} for df in kept[:-1]]
    assert len(by_id[0]) > 990
    rows = [(r.doc_id, r.text) for r in by_id[0].values()]
    assert set(by_id[1]) == {c for _, _, c in brute(rows)} and len(by_id[1]) < len(by_id[0])
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontamination.Index(items)
    words = decontamination.Words(index.vocabulary)
    leaky = {i for i, r in by_id[1].items() if decontamination.find_in(r.text, index, words)}
    assert leaky and set(by_id[2]) == set(by_id[1]) - leaky
    assert set(by_id[3]) == set(by_id[2])
    for i, r in by_id[3].items():
        old = by_id[2][i]
        assert not set(re.findall(r"[\w.]+@[\w.]+\w", old.text)) & set(re.findall(r"[\w.]+@[\w.]+\w", r.text))
        assert r.n_chars == (len(r.text) if r.text != old.text else old.n_chars)
        assert (r.text == old.text) or re.search("[0-9]", old.text)
    pieces = kept[-1].toPandas()
    assert set(pieces.doc_id) == set(by_id[3])
    assert pieces.groupby("sequence_id").length.sum().max() <= 2048


def test_run(spark):
    out = pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "ids_crc32", "length", "sequence_id", "offset"]
    assert out.count() > 500

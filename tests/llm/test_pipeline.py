"""The pipeline's stages on a small corpus with planted cases."""

import random

import corpus_pipeline
from medalyst.session import workspace
from tests.llm.conftest import words


def test_stages(spark):
    rng = random.Random(3)
    item = words(900, 30)
    rows, labels = [], []
    for i in range(160):
        good = i % 4 > 0
        text = words(i, 40) if good else " ".join(f"{w}$$$" for w in words(i, 40).split())
        rows.append([i, text, "en", f"s{i % 5}", len(text)])
        labels.append((i, int(good), 0))
    rows.append([200, rows[1][1] + " extra", "en", "s1", 0])
    rows.append([201, f"{words(50_000, 20)} {item} {words(50_001, 20)}", "en", "s1", 0])
    rows.append([202, words(50_002, 30) + " token = abcdef0123456789abcd", "en", "s2", 0])
    rows.append([203, None, "en", "s2", 0])
    rng.shuffle(rows)
    folder = workspace(spark, "tables")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            path = workspace(spark, "stage")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"]: r for r in out.collect()}
    bad = {i for i in range(160) if i % 4 == 0}
    after = kept["quality classifier"]
    assert len(bad & set(after)) <= 2 and len(set(range(160)) - bad - set(after)) == 0
    assert 1 in kept["near-duplicates"] and 200 not in kept["near-duplicates"]
    assert set(kept["near-duplicates"]) - set(kept["benchmark decontamination"]) == {201}
    assert kept["secret scan"][202]["text"].endswith("token = [SECRET]") and kept["secret scan"][202]["n_chars"] == len(kept["secret scan"][202]["text"])
    last = kept["byte-level tokens"]
    assert set(last) == set(kept["secret scan"]) and all(r["n_tokens"] == len(r["ids"]) // 4 for r in last.values())


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-duplicates", "benchmark decontamination", "secret scan", "byte-level tokens"]

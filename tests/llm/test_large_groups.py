"""The n-gram Jaccard join on a large group of near copies, and what the pipeline's stages leave and shuffle."""

import random
import tracemalloc
from pathlib import Path

import corpus_pipeline
from pyspark.sql import functions as F
from starwright import storage
from starwright.llm import jaccard_join, quality


def near_copies(number, seed=5):
    """Texts of 150 words, of which up to four are others."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    base = [word() for _ in range(150)]
    texts = []
    for _ in range(number):
        text = list(base)
        for at in rng.sample(range(150), rng.choice([0, 1, 1, 2, 2, 3, 3, 4])):
            text[at] = word()
        texts.append(" ".join(text))
    return texts


def test_candidates_follow_the_size_of_a_group(docs, monkeypatch):
    """All members meet a few central ones; those with many edits do not meet each other."""
    made, verified = [], jaccard_join._verified

    def counted(pairs, texts, shared):
        made.append(pairs.distinct().count())
        return verified(pairs, texts, shared)

    monkeypatch.setattr(jaccard_join, "_verified", counted)
    number = 700
    rows = jaccard_join.duplicates(docs(enumerate(near_copies(number)))).collect()
    assert sum(made) < 12 * number
    # Up to three edits leave 131 of 146 shingles, so those members are linked with the unedited text.
    assert sum(r["component_id"] == 0 for r in rows) > 0.8 * number


def test_rows_that_stay_are_those_without_a_key_that_goes(docs, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "KEY_BITS", 1 << 16)
    monkeypatch.setattr(corpus_pipeline, "ROW_BITS", 8 * 4096)
    rows = docs([(i - 2000, f"text {i}") for i in range(4000)])
    gone = rows.where("doc_id % 7 = 0").select("doc_id")
    want = {(i, f"text {i + 2000}") for i in range(-2000, 2000) if i % 7}
    got = [tuple(r) for r in corpus_pipeline._without(rows, gone, "doc_id").collect()]
    assert len(got) == len(want) and set(got) == want
    assert corpus_pipeline._without(rows, gone.limit(0), "doc_id").count() == 4000


def test_stage_of_near_copies_leaves_few_files(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_root", lambda spark: str(tmp_path))
    texts = near_copies(12) + [f"{i} lonely words number {i} of some text" for i in range(200)]
    read = docs(enumerate(texts)).withColumn("lang", F.lit("en"))
    kept = corpus_pipeline.near_duplicates(spark, read, "unused")
    assert {r["doc_id"] for r in kept.collect()} >= set(range(12, 212))
    folders = [p.name.rsplit("-", 1)[0] for p in Path(tmp_path, "starwright").iterdir()]
    assert sorted(folders) == ["keys-that-go", "later-of-groups", "numbered-_key", "repeated-ids"]


def test_fitting_keeps_the_sample_out_of_python_objects(docs, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(5000)]
    sample = docs([(i % 2, " ".join(rng.sample(words, 300))) for i in range(1500)]).select("text", F.col("doc_id").cast("int").alias("label"))
    seen = []
    monkeypatch.setattr(quality, "train", lambda features, label: seen.append((features, label)))
    quality.fit(sample)
    seen.clear()
    tracemalloc.start()
    try:
        quality.fit(sample)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    features, label = seen[0]
    assert len(label) == 1500 and features.start[-1] == len(features.bucket) == len(features.value) > 400_000
    assert set(label.tolist()) == {0.0, 1.0}
    assert peak < 80 * len(features.bucket)

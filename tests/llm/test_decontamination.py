import hashlib

from pyspark.sql import functions as F

from starwright.llm import decontamination

ITEM = " ".join(f"w{i}" for i in range(20))


def judged(spark, docs, rows, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string, extra string")
    frame = docs(rows).withColumn("item_id", F.lit(1)).withColumn("words", F.lit("x"))
    return {r["doc_id"]: r for r in decontamination.contamination(frame, benchmark).collect()}


def test_windows_short_items_and_edges(spark, docs):
    rows = [
        (1, "before " + ITEM.upper() + " after"),
        (2, " ".join(f"w{i}" for i in range(12)) + " no"),
        (3, "...two, WORDS; " + "z " * 39),
        (4, None),
        (5, ""),
        (6, " ".join(f"w{i}" for i in range(13)) + " x " + " ".join(f"w{i}" for i in range(7, 20))),
        (7, "two words " + "z " * 100),
    ]
    got = judged(spark, docs, rows, [(10, ITEM, "e"), (9, "two words", None), (11, None, None), (12, "", None), (13, "zz", None)])
    assert {i: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for i, r in got.items()} == {
        1: (22, 20, 1, True), 2: (13, 0, 0, False), 3: (41, 2, 1, False), 4: (0, 0, 0, False), 5: (0, 0, 0, False),
        6: (27, 26, 1, True), 7: (102, 2, 1, False),
    }
    assert got[1]["items_sha256"] == hashlib.sha256(b"10").hexdigest()
    assert got[4]["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_repeated_rows_empty_tables(spark, docs):
    got = decontamination.contamination(docs([(1, ITEM), (1, ITEM)]), spark.createDataFrame([(3, ITEM)], "item_id long, text string"))
    assert [(r["n_hit"], r["n_items"]) for r in got.collect()] == [(20, 1)] * 2
    assert judged(spark, docs, [], [(1, ITEM, None)]) == {}
    assert judged(spark, docs, [(1, ITEM)], [])[1]["n_hit"] == 0


def test_proximity(spark, docs):
    terms = spark.createDataFrame([("a", 1), ("b", 2)], "word string, term long")
    postings = decontamination.index(docs([(1, "a x x b"), (2, "a x x x x b b")]), terms)
    met = decontamination.near(postings, spark.createDataFrame([(1, 2)], "a long, b long"), 3)
    assert [(r["id"], r["pos_a"], r["pos_b"]) for r in met.collect()] == [(1, 0, 3)]

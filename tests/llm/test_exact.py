"""Operators against brute force: encoding, token files, embeddings, revisits, licences, the pipeline."""

import random
import textwrap
import time

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starwright.llm import bpe, embedding_dedup, licenses, revisits, token_files
from starwright.llm.common import prepare
from starwright.storage import scratch_dir

FOLDER = "/root/testdata/sf0.001"


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_and_text_equal_the_library(docs):
    rng = random.Random(4)
    alphabets = ["abn", "thein sr", "aeiountsr\n ", "é ñ中a1ü", "ABC 012'll", "= -_", " \t\nx\x85\x1c"]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 40))) for a in alphabets * 60]
    texts += [x for (x,) in duckdb.sql(f"SELECT text FROM '{FOLDER}/documents.parquet'").fetchall()]
    texts += ["x<|endoftext|>y", "<|endoftext|>", "a" * 30000, "", None]
    tool = library()
    for r in bpe.round_trip(docs(enumerate(texts))).collect():
        ids = tool.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == tool.decode(ids, skip_special_tokens=False)


def test_gadgets_of_repeated_symbols():
    """Merges of a label with itself take the first pair first, as applying merges one by one does."""
    a = bpe.Automaton(bpe.Compiled({b"a": 0, b"b": 1, b"aa": 2, b"ab": 3, b"aaab": 4}, [(b"a", b"a"), (b"a", b"b"), (b"aa", b"ab")], {}))
    assert [a.encode_word(x) for x in (b"aaa", b"aab", b"aaab", b"aaaab", b"ab")] == [[2, 0], [2, 1], [4], [2, 2, 1], [3]]


def test_small_tables_and_caches_change_nothing(monkeypatch):
    """States beside a full table, a table begun anew, and words that are not kept."""
    rng = random.Random(9)
    compiled = bpe.parse(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    words = ["".join(rng.choice("theinrsaou") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    text = " ".join(words + ["a" * 500, "ab" * 300])
    whole = bpe.Automaton(compiled).encode(text)
    assert np.frombuffer(whole, "<u4").tolist() == library().encode(text, add_special_tokens=False).ids
    for name, size in (("MOST_STATES", 50), ("MOST_BESIDE", 700), ("MOST_ARCS", 10), ("MOST_WORDS", 5), ("LONGEST_KEPT", 6)):
        monkeypatch.setattr(bpe, name, size)
        small = bpe.Automaton(compiled)
        assert small.encode(text) == whole
        assert len(small.content) <= bpe.MOST_STATES and len(small.arcs) <= bpe.MOST_ARCS and len(small.words) <= bpe.MOST_WORDS


def test_very_long_words_take_time_in_proportion():
    compiled = bpe.parse(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    automaton = bpe.Automaton(compiled)

    def seconds(n):
        start = time.process_time()
        assert len(automaton.encode("a" * n)) == n
        return time.process_time() - start

    seconds(1000)
    assert seconds(4_000_000) < 40
    assert len(automaton.words) == 0 or max(map(len, automaton.words)) <= bpe.LONGEST_KEPT


def test_round_trip_replaces_columns_of_its_names(docs):
    frame = docs([(1, "a b"), (1, "a b"), (None, None)]).withColumns({c: F.lit("x") for c in ("ids", "decoded", "n_tokens", "more")})
    got = bpe.round_trip(frame)
    assert got.columns == ["doc_id", "text", "more", "ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["decoded"]) for r in got.collect()) == [("1", 2, "a b"), ("1", 2, "a b"), ("None", 0, "")]
    assert bpe.round_trip(docs([])).count() == 0


def test_token_files(spark, docs):
    texts = ["one two", "", None, "<|endoftext|> in a text", "word " * 500]
    path = scratch_dir(spark, "test-tokens")
    token_files.write(bpe.encode(docs(enumerate(texts)), width=2, special=False).coalesce(2), path, bpe.END_OF_TEXT)
    tool = library()
    tool.encode_special_tokens = True
    want = sorted(len(tool.encode(t or "", add_special_tokens=False).ids) for t in texts)
    for block in (2, 6, 1 << 20):
        rows = token_files.count(spark, path, bpe.END_OF_TEXT, block=block).collect()
        assert sorted(r["n_tokens"] for r in rows) == want
        by_file = {}
        for r in sorted(rows, key=lambda r: (r["file"], r["doc_index"])):
            index, end = by_file.get(r["file"], (0, 0))
            assert (r["doc_index"], r["start"]) == (index, end)
            by_file[r["file"]] = (index + 1, end + r["n_tokens"] + 1)


def test_embeddings_against_brute_force(spark):
    prepare(spark)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 16))
    x = np.repeat(centres, 10, 0) + rng.normal(size=(300, 16)) * 0.15
    x[7] = x[3]
    rows = [(i, [float(c) for c in v], i % 2) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, rows[0][1], None), (904, [1.0, None], 1), (None, rows[0][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("weight", F.lit("clash"))
    got = {r["vec_id"]: r for r in embedding_dedup.duplicates(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (np.arange(300)[:, None] % 2 == np.arange(300) % 2) & ~np.eye(300, dtype=bool)
    assert sum(got[i]["n_links"] for i in range(300)) >= 0.9 * linked.sum()
    assert all(got[i]["n_links"] <= linked[i].sum() for i in range(300))
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in (900, 901, 902, 903, 904, None))
    assert embedding_dedup.duplicates(frame.limit(0)).count() == 0


def linked_pairs(rows):
    """(links of each row, least id reachable) by comparing all rows."""
    unit = {}
    for i, (_, v, label) in enumerate(rows):
        x = np.array(v, float)
        unit[i] = x / np.linalg.norm(x)
    near = {i: [j for j in unit if j != i and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.93 + 1e-12] for i in unit}
    out = []
    for i in unit:
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        out.append((rows[i][0], len(near[i]), min(rows[j][0] for j in seen)))
    return sorted(out)


def test_small_tables_of_embeddings_lose_no_link_and_repeated_ids_give_one_row_each(spark):
    prepare(spark)
    rng = np.random.default_rng(6)
    rows = []
    for label in range(60):
        centres = rng.normal(size=(3, 4))
        for i in range(rng.integers(4, 17)):
            rows.append((int(rng.integers(0, 400)), (centres[i % 3] + rng.normal(size=4) * 0.2).tolist(), label))
    axes = [(1, [1, 0, 0, 0]), (1, [0, 1, 0, 0]), (2, [1, 0, 0, 0.001]), (2, [0, 0, 1, 0]), (2, [0, 0, 0, 0]), (3, [1, 0, 0, 0])]
    rows += [(i, [float(c) for c in v], 99) for i, v in axes]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.duplicates(frame).collect()
    valid = [r for r in rows if any(r[1])]
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted([*linked_pairs(valid), (2, 0, 2)])


def test_traversal_visits_cells_in_order():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = np.sort(rng.random(rng.integers(1, 9))), np.sort(rng.random(rng.integers(1, 9)))
        sums = sorted(x + y for x in a for y in b)
        got = embedding_dedup._traversal(a.tolist(), b.tolist(), 12)
        assert len(set(got)) == len(got) == min(12, len(sums))
        assert np.allclose([a[i] + b[j] for i, j in got], sums[: len(got)])


def test_large_tables_visit_some_cells_and_keep_the_recall(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 300)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(300, 32))
    x = np.repeat(centres, 6, 0) + rng.normal(size=(1800, 32)) * 0.22
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    books, number = embedding_dedup._fit(embedding_dedup._unit(x[:300]), 1800, np.random.default_rng(1))
    assert number < len(books[0]) * len(books[1])
    want = {i: n for i, n, _ in linked_pairs(rows)}
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.duplicates(frame).collect()}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.97 * sum(want.values()) > 0


def test_revisits(spark):
    rows = [
        (1, "http://www.A.org/x/?utm_source=q#f", 10, False, {"etag": "t", "date": "1", "content-type": "h"}),
        (2, "https://a.org/x", 10, True, {"etag": "W/t", "date": "2", "content-length": "0"}),
        (3, "https://a.org/x", 9, True, {"etag": "t"}),
        (4, "https://a.org/x", 9_000_000, True, {"etag": "u"}),
        (5, "https://a.org/x", 9_000_000, True, {}),
        (6, None, 20, True, {"etag": "t"}),
        (7, "https://a.org/x", None, True, {"etag": "t"}),
    ]
    frame = spark.createDataFrame(rows, "capture_id long, url string, ts long, revisit boolean, headers map<string,string>")
    got = {r["capture_id"]: r for r in revisits.resolve(frame).collect()}
    assert {i: (r["refers_to"], r["state"]) for i, r in got.items()} == {
        2: (1, "resolved"), 3: (None, "no response"), 4: (None, "mismatch"), 5: (None, "no validator"), 6: (None, "no response"), 7: (None, "no response"),
    }
    assert got[2]["headers"] == {"etag": "W/t", "date": "2", "content-type": "h"}


def test_licence_bounds_lose_nothing(docs):
    texts = [(1, "x\nReleased under the MIT License.\n"), (2, None), (3, ""), (4, "released under the mit licence"), (5, licenses.TEMPLATES["MIT"].upper())]
    got = {(r["doc_id"], r["license_id"]) for r in licenses.scan(docs(texts)).collect()}
    assert got == {(1, "MIT-notice"), (5, "MIT")}


def test_licences_wrapped_over_lines(docs):
    """Runs of lines inside other text, against all runs by brute force."""
    rng = random.Random(8)
    rows = []
    for i in range(60):
        name = rng.choice(sorted(n for n in licenses.TEMPLATES if len(licenses.TEMPLATES[n]) < 2000))
        words, lines = licenses.TEMPLATES[name].split(), []
        while words:
            n = rng.randint(1, 14)
            lines.append(rng.choice(["", "# ", " * "]) + " ".join(words[:n]))
            words = words[n:]
        for _ in range(i % 3):
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(["", "of the software", "import os", lines[0]]))
        rows.append((i, "\n".join(["import this", " ".join(f"more{n}" for n in range(600)), *lines, "", "def f(the, software): " + "return None " * 40, *(lines if i % 7 == 0 else [])])))
    sets = {name: licenses.bigrams(text.encode()) for name, text in licenses.TEMPLATES.items()}

    def best(lines, s, most):
        units = (licenses.bigrams("\n".join(lines[i : j + 1]).encode()) for i in range(len(lines)) for j in range(i, min(i + most, len(lines))))
        return max(2 * len(b & s) / (len(b) + len(s)) for b in units)

    got = {(r["doc_id"], r["license_id"]): r for r in licenses.scan(docs(rows)).collect()}
    want = {(i, name): dice for i, text in rows for name, s in sets.items() if len(s) < 250 and (dice := best(text.split("\n"), s, 99)) >= licenses.LEAST_DICE}
    apart = {k for k in want if best(rows[k[0]][1].split("\n"), sets[k[1]], 1) < licenses.LEAST_DICE}
    assert len(apart) >= 40 and set(want) == {k for k in got if len(sets[k[1]]) < 250}
    assert all(abs(got[k]["dice"] - want[k]) < 1e-12 for k in apart)
    assert all(got[k]["first_line"] >= 3 for k in apart)
    assert all(got[k]["n_units"] >= 2 for k in apart if k[0] % 21 == 0)


def test_full_licence_texts_inside_other_text(docs):
    """A usual set of licences, as their files hold them."""
    names = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-2.1-header", "AGPL-3.0-header", "MPL-2.0"]
    wrap = lambda text: text if "\n" in text else textwrap.fill(text, 70)
    rows = [(i, "notes\n" + "before it " * 300 + "\n" + wrap(licenses.TEMPLATES[name]) + "\nfoo " * 900) for i, name in enumerate(names)]
    got = {(r["doc_id"], r["license_id"]) for r in licenses.scan(docs(rows)).collect()}
    assert {(i, name) for i, name in enumerate(names)} <= got


def test_pipeline_stages_leave_other_columns_alone(spark):
    """Columns with names that the operators use, null and repeated ids, repeated rows."""
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    odd = ("score", "_spoken", "lang_pred", "_quality", "_id", "_h", "h", "id", "component_id", "_key", "part", "_part", "n")
    base = frame.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in odd})
    spoken = frame.where("lang = 'en'").first()["text"]
    extra = [(7001, spoken), (7001, "words of another kind " * 40), (None, spoken), (None, None), (None, None), (7002, "")]
    others = spark.createDataFrame(extra, "doc_id long, text string").withColumns({c: F.lit(c) for c in odd})
    docs = base.unionByName(others, allowMissingColumns=True)
    whole = sorted(map(str, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns, name
        rows = sorted(map(str, kept.collect()))
        assert rows and set(rows) <= set(whole), name


def test_one_document_of_each_group_stays(docs, spark):
    """By brute force over rows: equal ids join nothing, null ids are compared, wordless texts stay."""
    rng = random.Random(2)
    text = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(90))
    first, second, third = text(), text(), text()
    near = first.replace(first.split()[40], "changed", 1)
    rows = [(7, first), (7, second), (7, third), (8, near), (9, first), (None, second), (None, second), (None, third + " more"), (None, None), (7, None), (3, ""), (3, "")]
    rows += [(9, first), (10, text())]
    frame = docs(rows).withColumn("place", F.monotonically_increasing_id())
    kept = corpus_pipeline.near_duplicates(spark, frame, FOLDER).collect()

    def shingles(x):
        words = (x or "").split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            x, y = shingles(rows[i][1]), shingles(rows[j][1])
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                group = [group[j] if g == group[i] else g for g in group]
    found = sorted((r["text"] or "") for r in kept)
    assert len(kept) == len(set(group))
    for g in set(group):
        texts = {rows[i][1] or "" for i in range(len(rows)) if group[i] == g}
        assert any(t in texts for t in found)
    assert {(r["doc_id"], r["text"]) for r in kept if r["text"]} >= {(7, second), (10, rows[-1][1])}


def test_the_run_leaves_no_intermediates(spark):
    """What a run writes to the shared folder is gone but for what its result reads."""
    from starwright.storage import folders, shared_root

    before = set(folders(spark, f"{shared_root(spark)}/starwright/*"))
    result = corpus_pipeline.run(spark, FOLDER)
    assert result.count() > 0
    left = {f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in set(folders(spark, f"{shared_root(spark)}/starwright/*")) - before}
    assert left <= {"pipeline-benchmark-decontamination"}


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [frame.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, FOLDER)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        path = scratch_dir(spark, "test-stage")
        frame.write.parquet(path)
        frame = spark.read.parquet(path)
        kept.append(frame.count())
    assert kept == sorted(kept, reverse=True) and kept[2] < kept[1] and kept[3] < kept[2] and kept[-1] > 0
    assert corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count() == kept[-1]

"""Manifest, filter audit and line removal on small tables, against plain Python."""

import hashlib
import random
import re
import zlib
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.llm import filter_audit, line_dedup, merkle
from starwright.llm.common import prepare

ROW = "doc_id long, source string, lang string, n_chars long, text string"
WHITE = " \t\n\v\f\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    """The top of a list of digests, and for each of them (left, right) by level."""
    paths, members, level = [[] for _ in digests], [[i] for i in range(len(digests))], list(digests)
    while len(level) > 1:
        above, holders = [], []
        for at in range(0, len(level), 3):
            run = level[at : at + 3]
            for i in range(len(run)):
                for leaf in members[at + i]:
                    paths[leaf].append((run[:i], run[i + 1 :]))
            above.append(sha("".join(run)))
            holders.append([x for i in range(len(run)) for x in members[at + i]])
        level, members = above, holders
    return level[0], paths


def expected_manifest(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    order = lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))
    groups = [sorted((r for r in rows if r[1] == s), key=order) for s in sources]
    tops = [tree([leaf_of(r) for r in g]) for g in groups]
    root, above = tree([t[0] for t in tops])
    out = []
    for g, (subroot, paths), up in zip(groups, tops, above):
        for row, path in zip(g, paths):
            proof = "".join("".join(left + right) for left, right in path + up)
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            at = leaf_of((*row[:4], row[4].replace("\n", ""))) if changed else leaf_of(row)
            for left, right in path + up:
                at = sha("".join(left) + at + "".join(right))
            out.append((row[0], leaf_of(row), subroot, root, sha(proof), at, at == root))
    return sorted(out, key=str)


def manifest(spark, rows):
    frame = spark.createDataFrame(rows, ROW).withColumns({"digest": F.lit(1), "tree": F.lit("x"), "size": F.lit(2)})
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = merkle.manifest(frame, tampered, F.replace("text", F.lit("\n"), F.lit("")))
    got = got.withColumn("proof_sha256", merkle.proof_digest(F.col("proof")))
    names = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in got.collect()), key=str)


def corpus(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "a\nb", "é中\n", "plain"])
            rows.append((rng.randrange(10**6), source, rng.choice([None, "en"]), rng.choice([None, 7]), text))
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"one": 1},
        {"a": 1, "b": 1},
        {"a": 4, None: 1},
        {f"s{i}": 1 for i in range(28)},
        {"hot": 90, "z": 30, "": 3, None: 2, "é": 10, "~": 28, "a": 1},
    ],
)
def test_manifest_of_trees_of_all_heights(spark, sizes):
    prepare(spark)
    rows = corpus(sizes)
    assert manifest(spark, rows) == expected_manifest(rows)


def test_manifest_null_ids_repeated_rows_and_long_texts(spark):
    prepare(spark)
    rows = corpus({"a": 5, None: 4}) + [(None, "a", None, None, None), (None, "a", "x", None, "t\n")]
    rows += [(5, "a", "x", 1, "same\n")] * 4 + [(5, "a", "x", 1, "other")] + [(6, "b", None, 3, "line\n" * 300_000)]
    got = manifest(spark, rows)
    assert got == expected_manifest(rows)
    assert len({r[6] for r in got}) == 2
    assert manifest(spark, []) == []


def fails(row, rows):
    text = row[1] or ""
    words = [w for w in re.split(f"[{WHITE}]+", text) if w]
    copy = row[0] is not None and any(r[0] is not None and r[0] < row[0] and (r[1] or "") == text for r in rows)
    tests = (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), any(c in "#$%&*|" for c in text), copy,
    )
    return {f for f, bad in zip("ABCDE", tests) if bad}


def audited(rows, labels):
    marks = {}
    for doc, quality, toxic in labels:
        if doc is not None:
            good, bad = marks.get(doc, (0, 0))
            marks[doc] = (good or int(quality == 1), bad or int(toxic == 1))
    out = []
    judged = [(r[2] or "", fails(r, rows), *marks.get(r[0], (0, 0))) for r in rows]
    for part in {j[0] for j in judged}:
        docs = [j[1:] for j in judged if j[0] == part]
        removals = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                earlier = set(order[: step - 1])
                gone = [d for d in docs if f in d[0] and not d[0] & earlier]
                removals[f] += len(gone)
                kept = sum(not d[0] & set(order[:step]) for d in docs)
                late = sum(f in d[0] and bool(d[0] & earlier) for d in docs)
                only = sum(d[0] == {f} for d in docs)
                steps.append([part, order, step, kept, len(gone), late, only, sum(d[1] for d in gone), sum(d[2] for d in gone)])
        out += [(*s, removals[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def audit(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"n": F.lit("x"), "failed": F.lit(9), "good": F.lit(1)})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("lang", F.lit("zz"))
    names = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return sorted(tuple(r[n] for n in names) for r in filter_audit.audit(docs, marks).collect())


def test_audit_counts_every_order_and_step(spark):
    prepare(spark)
    rng = random.Random(7)
    texts = [None, "", "AB ab", "# x", " ".join(f"w{i}" for i in range(200)), "a b " * 150, "a\x0bb\x85c " * 90 + "$", "É" * 99 + "AAA", "É" * 96 + "AAA"]
    texts += [" ".join(f"{rng.choice('abX')}{i}" for i in range(rng.choice([150, 260]))) + rng.choice(["", " 5%"]) for _ in range(20)]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(150)]
    rows += [(7, texts[4], "en")] * 3 + [(300, "long word " * 200_000, "de")]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    got = audit(spark, rows, labels)
    assert got == audited(rows, labels)
    assert audit(spark, rows, []) == audited(rows, [])
    assert audit(spark, [], labels) == []


def test_potential_is_the_recursion(spark):
    values = [0] + [random.Random(3).randrange(100) for _ in range(31)]
    got = spark.createDataFrame([(values,)], "n array<long>").select(filter_audit.potential().alias("p")).first()["p"]
    plain = [0.0] * 32
    for s in range(1, 32):
        inside = [i for i in range(5) if s >> i & 1]
        plain[s] = (values[s] + sum(plain[s ^ 1 << i] for i in inside)) / len(inside)
        assert got[s] == pytest.approx(factorial(len(inside)) * plain[s])


def lines_kept(rows):
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(WHITE))
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(-1 if doc is None else doc)
    owner = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if owner.get(key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def dedup(spark, rows, **options):
    frame = spark.createDataFrame(rows, T.StructType().add("doc_id", "long").add("text", "string"))
    frame = frame.withColumns({c: F.lit("clash") for c in ("id", "row", "places", "n_lines", "owner", "_own", "_row", "h1", "batch")})
    got = line_dedup.dedup(frame, **options)
    assert "_own" in got.columns and got.columns[-3:] == ["n_lines", "n_dropped", "kept"]
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"batches": 1}, {"batches": 9, "fanout": 3}])
def test_lines_dropped_everywhere_but_in_the_greatest_id(spark, options):
    prepare(spark)
    rng = random.Random(11)
    lines = [f"a line that is long enough, number {i}" for i in range(40)]
    lines += ["x" * 19, "x" * 20, "é" * 19, "É" * 20, "中" * 20, "", " ", "\x85" + "y" * 19, "tab\tinside the long line here"]
    rows = []
    for i in range(80):
        chosen = [rng.choice(lines) for _ in range(rng.randrange(6))]
        pad = lambda x: rng.choice(["", " ", "\t\r", "\v\f"]) + rng.choice([x, x.upper() if x.isascii() else x]) + rng.choice(["", " "])
        rows.append((rng.choice([None, *range(60)]) if i % 9 == 0 else i, "\n".join(map(pad, chosen))))
    rows += [(200, None), (201, ""), (202, "\n\n"), rows[3], rows[3], (203, "\n".join(lines * 2)), (204, "w" * 100_000 + "\n" * 50_000)]
    got = dedup(spark, rows, **options)
    assert got == lines_kept(rows)
    assert sum(r[2] for r in got) > 20


def test_no_documents_no_lines(spark):
    prepare(spark)
    assert dedup(spark, []) == []
    assert dedup(spark, [(1, None), (None, "")]) == [(1, 1, 0, ""), (None, 1, 0, "")]


def test_settled_lines_are_not_added_again(spark):
    """A run holds what no earlier run has settled; full levels become one run of the next."""
    prepare(spark)
    index = line_dedup.LineRuns(spark, buckets=4)
    sizes = []
    for batch in range(4):
        ids = [100 - 10 * batch - i for i in range(5)]
        index.add(spark.createDataFrame([(i, 1, 1) for i in ids] + [(ids[0], 2, batch)], "id long, h1 long, h2 long"))
        sizes.append([[spark.table(name).count() for name in level] for level in index.levels])
    assert sizes == [[[2]], [[], [3]], [[1], [3]], [[], [], [5]]]
    assert [tuple(r) for r in index.repeated().collect()] == [(1, 1, 100)]

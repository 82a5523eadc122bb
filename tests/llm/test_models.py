"""Trained operators: accuracy on held-out rows, and defined results at the edges."""

from pathlib import Path

import duckdb
import numpy as np

from starwright.llm import bpe, language_id, lm_scoring, quality
from starwright.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def truth(table, column):
    return dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{FOLDER}/{table}.parquet'").fetchall())


def test_language_of_held_out_documents(spark):
    lang = truth("documents", "lang")
    rows = [r for r in QUERIES["op2_language_id"](spark, FOLDER).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark, docs):
    learnt = docs([(i, t) for i, t in enumerate(["the cat and the dog"] * 3 + [None])])
    from pyspark.sql import functions as F

    model = language_id.fit(learnt.withColumn("lang", F.lit("en")))
    got = {r["doc_id"]: r for r in language_id.predict(docs([(1, None), (2, "12 ..."), (3, "the dog"), (4, "")]).withColumn("score", F.lit("x")), model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4)] == ["und", "und", "en", "und"]
    none = language_id.fit(docs([]).withColumn("lang", F.lit("en")))
    assert language_id.predict(docs([(1, "words")]), none).first()["lang_pred"] == "und"


def test_code_lengths_do_not_depend_on_slices(spark, docs, monkeypatch):
    from pyspark.sql import functions as F

    model = language_id.fit(docs([(1, "abc abd abe"), (2, "xyz")]).withColumn("lang", F.col("doc_id").cast("string")))
    texts = [b"abc xyz abd", b"", b"zzz abe"]
    whole = language_id.code_lengths(model, texts)
    monkeypatch.setattr(language_id, "SLICE", 3)
    np.testing.assert_allclose(language_id.code_lengths(model, texts), whole, rtol=1e-6)


def test_quality_of_held_out_documents(spark):
    label = truth("labels", "quality")
    rows = [r for r in QUERIES["op8_quality"](spark, FOLDER).collect() if r["held_out"] and r["doc_id"] in label]
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in rows]) > 0.9


def test_factorisation_identity():
    """The linear-time sum equals the sum over all pairs."""
    rng = np.random.default_rng(1)
    n = quality.BUCKETS + len(quality.STRUCTURE)
    model = quality.FactorModel(0.1, rng.normal(size=n), rng.normal(size=(n, quality.FACTORS)), np.zeros(len(quality.STRUCTURE)), np.ones(len(quality.STRUCTURE)))
    f = quality.features([b"some words and some more!", b""], quality.Memo(quality._bucket))
    margin = quality._margin(model, f)[0]
    at = np.concatenate([f.bucket, np.arange(quality.BUCKETS, n)])
    x = np.concatenate([f.value, f.structure[0]])
    pairs = sum(model.factor[at[i]] @ model.factor[at[j]] * x[i] * x[j] for i in range(len(x)) for j in range(i))
    np.testing.assert_allclose(margin[0], 0.1 + model.weight[at] @ x + pairs)


def test_quality_without_labels(docs):
    assert [r["score"] for r in quality.score(docs([(1, None), (2, "a")]), None).collect()] == [0.5, 0.5]


def test_each_id_is_scored_once_with_all_its_context():
    """Windowed scores equal one position at a time, as far back as the window sees."""
    rng = np.random.default_rng(2)
    texts = [[[int(i)] for i in rng.integers(0, 200, 70)] for _ in range(6)]
    steps, lm_scoring.STEPS = lm_scoring.STEPS, 5
    try:
        m = lm_scoring.fit(texts, 300)
    finally:
        lm_scoring.STEPS = steps
    classes = rng.integers(0, lm_scoring.END, 90).astype(np.uint8)
    got = lm_scoring.log_probabilities(m, classes, np.array([50, 40]))
    assert len(got) == 90
    for text in (classes[:50], classes[50:]):
        x = np.concatenate([[lm_scoring.END], text[:-1]])
        for t in range(len(text)):
            first = max(0, t // lm_scoring.STRIDE * lm_scoring.STRIDE - lm_scoring.STRIDE)
            e = m.embed[x[first : t + 1]]
            s = (m.embed[x[t]] @ m.query) @ (e @ m.key).T * lm_scoring.WIDTH**-0.5
            s = s + m.bias[0, lm_scoring.STRIDE - np.arange(t - first, -1, -1)] if t - first <= lm_scoring.STRIDE else s + np.array(
                [m.bias[-1, lm_scoring.WINDOW - 1 - d] for d in range(t - first, -1, -1)]
            )
            p = np.exp(s - s.max())
            z = (p / p.sum()) @ (e @ m.value) + m.embed[x[t]]
            logits = z @ m.out + m.direct[x[t]]
            want = (logits[text[t]] - np.log(np.exp(logits).sum())) / np.log(10)
            np.testing.assert_allclose(got[t + (50 if text is not classes[:50] and len(text) == 40 else 0)], want, rtol=1e-3)


def test_base_scores_and_edges(docs):
    rows = [(1, "a b a"), (2, None), (3, "A c")]
    got = {r["doc_id"]: r for r in lm_scoring.score(docs(rows), docs(rows[:2])).collect()}
    mass = 5 + 0.5 * (3 + 1)  # tokens a a b and two ends, of three kinds
    np.testing.assert_allclose(got[3]["base_score"], np.log10([2.5 / mass, 0.5 / mass, 2.5 / mass]).sum())
    assert (got[3]["n_tokens"], got[3]["n_known"], got[3]["train_tokens"]) == (3, 2, 5)
    assert got[2]["n_tokens"] == 1 and got[2]["score"] < 0
    assert lm_scoring.score(docs([(1, "x")]), docs([])).first()["n_known"] == 0


def test_share_of_earlier_words():
    tokens = np.array([7, 3, 7, 7, 3], np.uint64)
    np.testing.assert_allclose(lm_scoring.earlier_share(tokens), [0, 0, 1 / 2, 2 / 3, 1 / 4])
    assert len(lm_scoring.earlier_share(tokens[:0])) == 0


def test_model_beats_base_on_held_out_documents(spark):
    rows = [r for r in QUERIES["op1_lm_scoring"](spark, FOLDER).collect() if r["held_out"]]
    score, base, n = (sum(r[c] for r in rows) for c in ("score", "base_score", "n_tokens"))
    print("held out, log10 a token: model", score / n, "base", base / n)
    assert score > base


def test_language_sample_with_one_key_for_all(docs):
    from pyspark.sql import functions as F

    same = docs([(1, "the cat")] * 50 + [(None, "xyz")]).withColumn("lang", F.lit("en"))
    assert language_id.predict(docs([(1, "the cat")]), language_id.fit(same, sample_rows=2)).first()["lang_pred"] == "en"


def test_words_before_a_mark_are_spelled_as_a_whole():
    """Letters and a closing mark spelled apart give the classes of the word spelled at once."""
    automaton = bpe.Automaton(bpe.parse(Path(bpe.default_vocabulary()).read_text(encoding="utf-8")))
    steps, lm_scoring.STEPS = lm_scoring.STEPS, 2
    try:
        model = lm_scoring.fit([[automaton.spell(b"the"), automaton.spell(b"cat.")] * 20], len(automaton.label))
    finally:
        lm_scoring.STEPS = steps
    memo = lm_scoring.spelled_words(model, automaton, {})
    for word in (b"cat", b"cat.", b"unheardof!", b"a..", b".", b"it's", b"x:", "für,".encode(), b"\xff.", b"9."):
        classes = bytes(model.own[i] for i in automaton.spell(word))
        within = sum(model.rest.get(i, model.unseen) for i in automaton.spell(word) if model.own[i] == lm_scoring.REST)
        assert memo[word][1] == classes
        np.testing.assert_allclose(memo[word][2], within)


def test_scores_do_not_depend_on_the_words_sent_to_all_tasks(docs, monkeypatch):
    """Rare words meet their counts in a join, also for the model's score."""
    training = [(i, "the cat and the dog saw the cat " + "seldom " * (i % 3)) for i in range(9)] + [(9, None)]
    rows = docs([*training, (10, "a seldom cat, unheard of: seldom unheard"), (11, "")])
    monkeypatch.setattr(lm_scoring, "STEPS", 2)
    scores = lambda: {r["doc_id"]: (r["n_known"], r["base_score"], r["score"]) for r in lm_scoring.score(rows, docs(training)).collect()}
    want = scores()
    monkeypatch.setattr(lm_scoring, "HEAD", 2)
    got = scores()
    assert len(got) == 12
    for i in want:
        np.testing.assert_allclose(got[i], want[i], rtol=1e-9)


def test_all_training_rows_are_learnt_from(spark, docs):
    """Counts are those of all rows' ids, in any number of tasks, and every window is stepped on once."""
    words = ["river", "stone", "light", "cloud"]
    texts = [" ".join(words[(i + j) % 4] for j in range(60)) for i in range(900)] + ["zebra " * 400, None]
    definition = bpe.Definition(spark, bpe.default_vocabulary())
    automaton = definition.automaton()
    model = lm_scoring.learnt(docs(enumerate(texts)).select("text").repartition(3), definition, len(automaton.label))
    ids = [i for t in texts for w in (t or "").encode().split() for i in automaton.spell(w)]
    n = np.bincount(ids, minlength=len(automaton.label))
    own, rest, unseen = lm_scoring.ranked_classes(np.flatnonzero(n), n[n > 0], len(n))
    np.testing.assert_array_equal(model.own, own)
    assert (model.rest, model.unseen) == (rest, unseen)
    zebra = bytes(own[i] for i in automaton.spell(b"zebra"))
    assert lm_scoring.REST not in zebra  # its 400 words are in a single text
    river = np.frombuffer(b"".join(bytes(own[i] for i in automaton.spell(w.encode())) for w in words * 15) + bytes([lm_scoring.END]), np.uint8)
    begun = lm_scoring.untrained(own, rest, unseen, lm_scoring.pair_counts(river), np.random.default_rng(5))
    lengths = np.array([len(river)])
    assert lm_scoring.log_probabilities(model, river, lengths).sum() > lm_scoring.log_probabilities(begun, river, lengths).sum()


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    classes, lengths = rng.integers(0, lm_scoring.CLASSES, 90).astype(np.uint8), np.array([50, 40])
    pairs = rng.integers(0, 9, lm_scoring.CLASSES**2)
    m = lm_scoring.untrained(np.zeros(1, np.uint8), {}, 0.0, pairs, rng)
    m.out = rng.normal(0, 0.3, m.out.shape)
    for name in lm_scoring.TRAINED:
        setattr(m, name, getattr(m, name).astype(np.float64))
    cut = lm_scoring._cut(classes, lengths, *lm_scoring.windows(lengths))
    g = lm_scoring._gradients(m, *cut)

    def loss():
        m.bias = lm_scoring._relative(m.distance).astype(np.float64)
        p = lm_scoring._softmax(lm_scoring._forward(m, *cut[:2])[-1])
        return -np.log(np.take_along_axis(p, cut[2][..., None], -1)[..., 0])[cut[3]].mean()

    for name in lm_scoring.TRAINED:
        array, most = getattr(m, name), np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        step = 1e-3
        array[most] += step
        up = loss()
        array[most] -= 2 * step
        down = loss()
        array[most] += step
        np.testing.assert_allclose(g[name][most], (up - down) / (2 * step), rtol=0.02, err_msg=name)


def test_frequent_ids_are_told_apart_and_the_window_reaches_far():
    """126 ids have classes of their own, and every id is predicted from the 32 before it at least."""
    n = np.arange(200, 0, -1)
    own, rest, _ = lm_scoring.ranked_classes(np.arange(200), n, 300)
    assert len(set(own[:126].tolist())) == 126 and lm_scoring.REST not in own[:126] and 125 not in rest
    rng = np.random.default_rng(6)
    m = lm_scoring.untrained(own, rest, 0.0, np.ones(lm_scoring.CLASSES**2, np.int64), rng)
    m.out = rng.normal(0, 1, m.out.shape).astype(np.float32)
    m.embed, classes, lengths = m.embed * 10, rng.integers(0, 100, 200).astype(np.uint8), np.array([200])
    want = lm_scoring.log_probabilities(m, classes, lengths)
    for at in range(40, 200, 13):
        other = classes.copy()
        other[at - 32] = (other[at - 32] + 50) % 100  # the input at - 31, 32 inputs with the target's own
        assert lm_scoring.log_probabilities(m, other, lengths)[at] != want[at]


def test_a_language_keeps_its_tables_as_others_are_added(docs, monkeypatch):
    """Contexts and counts are ranked within each language, so other languages take none away."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(language_id, "CELLS", 40 * language_id.SYMBOLS)
    monkeypatch.setattr(language_id, "MOST_COUNTS", 60)
    small = [(1, "abcabd abc bad")]
    large = [(i, "the quick brown fox jumps over a lazy dog abcd " * 20) for i in range(2, 8)]
    labelled = lambda rows: docs(rows).withColumn("lang", F.when(F.col("doc_id") == 1, "a").otherwise(F.concat(F.lit("b"), "doc_id")))
    texts = [b"abc abd", b"bad"]
    alone = language_id.code_lengths(language_id.fit(labelled(small)), texts)[:, 0]
    np.testing.assert_allclose(language_id.code_lengths(language_id.fit(labelled(small + large)), texts)[:, 0], alone, rtol=1e-5)

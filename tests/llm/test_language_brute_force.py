"""Code lengths of the language model against a plain recursion over context counts."""

import math
import random
from collections import Counter, defaultdict

import pytest

from starwright.llm import language_id, lm_scoring, quality
from starwright.llm.common import prepare

ORDER, SYMBOLS = language_id.ORDER, language_id.SYMBOLS


def symbols(model, text):
    return [int(model.symbol[b]) for b in text.encode().translate(language_id.FOLDED)]


def recursion(model, training):
    """The probability of a symbol after a context, by prediction by partial matching, method C."""
    counts = defaultdict(Counter)
    x = symbols(model, " " * ORDER + training)
    for order in range(ORDER + 1):
        for i in range(order, len(x)):
            counts[tuple(x[i - order : i])][x[i]] += 1
    memo = {}

    def probabilities(context):
        if context not in memo:
            shorter = probabilities(context[1:]) if context else [1 / SYMBOLS] * SYMBOLS
            found = counts.get(context)
            if not found:
                memo[context] = shorter
            else:
                total, distinct = sum(found.values()), len(found)
                room = sum(p for s, p in enumerate(shorter) if s not in found)
                escape = distinct if room > 0 else 0
                memo[context] = [
                    found[s] / (total + escape) if s in found else (p / room * escape / (total + escape) if room > 0 else 0.0)
                    for s, p in enumerate(shorter)
                ]
        return memo[context]

    return probabilities


def test_code_lengths_are_those_of_the_recursion(spark):
    prepare(spark)
    rng = random.Random(1)
    languages = {"xa": "abcde ", "xb": "defgh ", "xc": "éñabз中 "}
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 8)))
    training = {name: " ".join(word(letters) for _ in range(400)) for name, letters in languages.items()}
    rows = [(i, name, text) for i, (name, text) in enumerate(training.items())]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3, "lang"))
    assert model.languages == sorted(languages)
    texts = [" ".join(word(rng.choice(list(languages.values()))) for _ in range(30)) for _ in range(12)]
    texts += ["", "a", "ABC, abc!", "zzz quite other words 123", "中中中"]
    got = language_id.code_lengths(model, [t.encode() for t in texts])
    for column, name in enumerate(model.languages):
        plain = recursion(model, training[name])
        for row, text in enumerate(texts):
            x = symbols(model, " " * ORDER + text)
            want = -sum(math.log2(plain(tuple(x[i - ORDER : i]))[x[i]]) for i in range(ORDER, len(x)))
            assert got[row, column] == pytest.approx(want, rel=1e-5, abs=1e-4)


def test_probabilities_after_every_context_sum_to_one(spark):
    prepare(spark)
    rows = [(1, "xa", "the cat and the hat"), (2, "xb", "le chat et le chapeau")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    for bits in model.bits:
        assert (2.0 ** -bits.reshape(-1, SYMBOLS).astype(float)).sum(1) == pytest.approx(1, rel=1e-5)


def test_empty_tables_of_the_learning_operators(docs, spark):
    none = docs([])
    labelled = spark.createDataFrame([], "doc_id long, lang string, text string")
    model = language_id.fit(labelled)
    assert language_id.predict(none, model).count() == 0
    assert [r["lang_pred"] for r in language_id.predict(docs([(1, "words")]), model).collect()] == ["und"]
    learnt = quality.fit(quality.labelled_sample(none, spark.createDataFrame([], "doc_id long, quality int"), "quality"))
    assert quality.score(none, learnt).count() == 0
    assert [r["score"] for r in quality.score(docs([(1, None)]), learnt).collect()] == [0.5]
    assert lm_scoring.score(none, none).count() == 0


def test_repeated_rows_and_other_columns_of_the_learning_operators(docs, spark):
    from pyspark.sql import functions as F

    rows = [(1, "some words here"), (1, "some words here"), (None, "more of it"), (2, None), (2, "")]
    frame = docs(rows).withColumns({c: F.lit("x") for c in ("id", "score", "lang_pred", "n", "token", "row")})
    training = spark.createDataFrame([(1, "xa", "some words"), (2, "xb", "andere worte")], "doc_id long, lang string, text string")
    predicted = language_id.predict(frame, language_id.fit(training)).collect()
    assert len(predicted) == 5 and len({(r["doc_id"], r["text"], r["lang_pred"], r["score"]) for r in predicted}) == 4
    scored = lm_scoring.score(frame, frame).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in scored) == [("1", 4), ("1", 4), ("2", 1), ("2", 1), ("None", 4)]
    same = {(r["base_score"], r["score"]) for r in scored if r["doc_id"] == 1}
    assert len(same) == 1

"""Operators 1 and 5: nothing is dropped beyond the classes, and one rule for tables of all sizes."""

import numpy as np

from starwright.llm import embedding_dedup, lm_scoring


def test_every_id_has_an_exact_share_of_the_classes():
    """Ids without a class of their own keep their own frequency, and all shares sum to one."""
    rng = np.random.default_rng(2)
    n_ids = 1000
    ids = rng.permutation(n_ids)[:700]
    n = rng.integers(1, 10_000, len(ids))
    own, rest, unseen = lm_scoring.ranked_classes(ids, n, n_ids)
    with_class = np.flatnonzero(own != lm_scoring.REST)
    assert len(set(own[with_class].tolist())) == len(with_class) == lm_scoring.REST
    assert set(rest) == set(ids.tolist()) - set(with_class.tolist())
    shares = np.array([rest.get(i, unseen) for i in range(n_ids) if own[i] == lm_scoring.REST])
    assert np.isclose((10**shares).sum(), 1)
    count = dict(zip(ids.tolist(), n.tolist(), strict=True))
    assert all(np.isclose(10 ** (rest[i] - unseen), 2 * count[i] + 1) for i in rest)


def test_visits_follow_one_rule_and_lose_no_link_of_the_sample(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(80, 16))
    x = np.repeat(centres, 5, 0) + rng.normal(size=(400, 16)) * 0.2
    unit = embedding_dedup._unit(x)
    books, number = embedding_dedup._fit(unit, len(x), np.random.default_rng(11))
    assert number < len(books[0]) * len(books[1])  # also where the sample is the table
    want = (unit @ unit.T >= embedding_dedup.LEAST_COSINE).sum(1) - 1
    assert want.sum() > 400
    homes, visits = embedding_dedup._homes(unit, books), embedding_dedup._visits(unit, books, number)
    i, j = np.nonzero(unit @ unit.T >= embedding_dedup.LEAST_COSINE)
    assert (visits[i] == homes[j][:, None]).any(1).all()
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.duplicates(frame).collect()}
    assert got == dict(enumerate(want.tolist()))

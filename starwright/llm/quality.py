"""Quality classifier: a factorisation machine over hashed words and structure.

A text's features are its distinct words, hashed to ``BUCKETS`` and weighted by
log counts, and statistics of its structure (its length as metadata among
them). The model is w0 + Σ w_i x_i + Σ_{i<j} <v_i, v_j> x_i x_j; the pairwise
sum is ½ Σ_f [(Σ v_if x_i)² − Σ v_if² x_i²], linear in the features a text has.

The fit uses whole texts of up to ``sample_rows`` labelled rows, those whose
ids hash lowest; scoring reads every whole text.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.storage import written

from .common import Memo, runs, texts_of, words_of

BUCKETS = 1 << 13
#: The score from which a document is predicted, and kept, as good.
GOOD = 0.7
FACTORS = 8
#: Bytes of text whose features are computed at once.
SLICE = 1 << 21
STRUCTURE = ("length", "letters", "capitals", "digits", "marks", "spaces", "lines", "word length", "new words", "marked words")
CLASSES = 6


def _classes() -> np.ndarray:
    """Of each byte: 0 lower-case letter or part of a longer character, 1 capital, 2 digit, 3 mark, 4 space, 5 line end."""
    out = np.full(256, 3, np.uint8)
    out[0x80:] = 0
    out[0x61:0x7B] = 0
    out[0x41:0x5B] = 1
    out[0x30:0x3A] = 2
    out[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 4
    out[0x0A] = 5
    return out


CLASS = _classes()


@dataclass
class Features:
    """Sparse rows: the hashed words of row i are at start[i]:start[i + 1]; structure is dense."""

    start: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    structure: np.ndarray


@dataclass
class FactorModel:
    bias: float
    weight: np.ndarray  # of buckets, then of structure
    factor: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray


def _bucket(word: bytes) -> tuple[int, bool]:
    last = word[-1]
    letter = last >= 0x80 or 0x30 <= last <= 0x39 or 0x61 <= last <= 0x7A
    return zlib.crc32(word) % BUCKETS, not (letter or last in b".,")


def features(texts: list[bytes], memo: Memo) -> Features:
    """Features of whole texts; an empty text has no words and zeros."""
    starts, buckets, values, structure = [0], [], [], np.zeros((len(texts), len(STRUCTURE)))
    for i, text in enumerate(texts):
        words = words_of(text)
        if not words:
            starts.append(starts[-1])
            continue
        pairs = np.array([memo[w] for w in words], np.int64)
        found, n = np.unique(pairs[:, 0], return_counts=True)
        x = np.log1p(n)
        buckets.append(found)
        values.append(x / np.sqrt((x * x).sum()))
        starts.append(starts[-1] + len(found))
        share = np.bincount(CLASS[np.frombuffer(text, np.uint8)], minlength=CLASSES) / len(text)
        structure[i] = (
            np.log(len(text)), share[0] + share[1], share[1], share[2], share[3], share[4], share[5],
            len(text) / len(words), len(set(words)) / len(words), pairs[:, 1].mean(),
        )
    none = np.zeros(0)
    return Features(
        np.array(starts), np.concatenate([none.astype(np.int64), *buckets]), np.concatenate([none, *values]), structure
    )


def _sums(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``x`` between starts; empty ranges are zero."""
    out = np.zeros((len(start) - 1, *x.shape[1:]))
    some = np.flatnonzero(start[1:] > start[:-1])
    if len(some):
        out[some] = np.add.reduceat(x, start[some], axis=0)
    return out


def _margin(model: FactorModel, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The model's value before the logistic function, the factor sums, and the standard structure."""
    s = (f.structure - model.mean) / model.deviation
    v, vs = model.factor[f.bucket], model.factor[BUCKETS:]
    vx = v * f.value[:, None]
    total = _sums(vx, f.start) + s @ vs
    squares = _sums((vx * vx).sum(1), f.start) + (s * s) @ (vs * vs).sum(1)
    linear = _sums(model.weight[f.bucket] * f.value, f.start) + s @ model.weight[BUCKETS:]
    return model.bias + linear + 0.5 * ((total * total).sum(1) - squares), total, s


def scores(model: FactorModel, f: Features) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_margin(model, f)[0], -30, 30)))


def train(f: Features, label: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> FactorModel:
    """Minimise log loss by AdaGrad over shuffled batches."""
    rng = np.random.default_rng(seed)
    n = BUCKETS + len(STRUCTURE)
    mean, deviation = f.structure.mean(0), f.structure.std(0) + 1e-6
    model = FactorModel(0.0, np.zeros(n), rng.normal(0, 0.05, (n, FACTORS)), mean, deviation)
    share = min(max(label.mean(), 0.01), 0.99)
    model.bias = float(np.log(share / (1 - share)))
    gw, gv = np.full(n, 1e-4), np.full((n, FACTORS), 1e-4)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(label)), -(-len(label) // batch)):
            sizes = f.start[rows + 1] - f.start[rows]
            start = np.concatenate([[0], np.cumsum(sizes)])
            at = np.arange(start[-1]) + np.repeat(f.start[rows] - start[:-1], sizes)
            part = Features(start, f.bucket[at], f.value[at], f.structure[rows])
            margin, total, s = _margin(model, part)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[rows]) / len(rows)
            row = np.repeat(np.arange(len(rows)), sizes)
            touched, where = np.unique(part.bucket, return_inverse=True)
            x, g = part.value, slope[row]
            dw = np.bincount(where, weights=g * x, minlength=len(touched))
            dv = np.zeros((len(touched), FACTORS))
            np.add.at(dv, where, (g * x)[:, None] * (total[row] - model.factor[part.bucket] * x[:, None]))
            ds = s.T @ slope
            dvs = (s * slope[:, None]).T @ total - ((s * s).T @ slope)[:, None] * model.factor[BUCKETS:]
            at = np.concatenate([touched, np.arange(BUCKETS, n)])
            dw = np.concatenate([dw, ds]) + decay * model.weight[at]
            dv = np.concatenate([dv, dvs]) + decay * model.factor[at]
            gw[at] += dw * dw
            gv[at] += dv * dv
            model.weight[at] -= rate * dw / np.sqrt(gw[at])
            model.factor[at] -= rate * dv / np.sqrt(gv[at])
            model.bias -= rate * slope.sum()
    return model


def _texts_by_slice(texts: list[bytes]):
    for a, b in runs(map(len, texts), SLICE):
        yield texts[a:b]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, text: str = "text", key: str = "doc_id", sample_rows: int = 4000) -> DataFrame:
    """(text, label) of the documents of up to ``sample_rows`` labelled ids, those that hash lowest.

    Null ids and labels are left out; an id that is labelled or stored more
    than once counts with each of its rows.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"))
    chosen = written(known.orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows), "quality-labels")
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(chosen, "id").select("text", "label")


def fit(sample: DataFrame) -> FactorModel | None:
    """Learn from a bounded frame of (text, label) rows; None if it is empty, and all scores are then 0.5."""

    def compute(batches):
        memo = Memo(_bucket)
        for batch in batches:
            f = features(texts_of(batch.column(0)), memo)
            cut = [slice(a, b) for a, b in zip(f.start[:-1], f.start[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f.bucket[c].astype(np.int32) for c in cut], pa.list_(pa.int32())),
                    pa.array([f.value[c].astype(np.float32) for c in cut], pa.list_(pa.float32())),
                    pa.array(list(f.structure), pa.list_(pa.float64())),
                    batch.column(1),
                ],
                names=["bucket", "value", "structure", "label"],
            )

    schema = "bucket array<int>, value array<float>, structure array<double>, label int"
    got = sample.mapInArrow(compute, schema).toArrow().combine_chunks()
    if not got.num_rows:
        return None
    # Straight from Arrow's buffers: as Python objects they would fill the driver.
    flat = lambda name: got.column(name).combine_chunks()
    bucket, value, label = flat("bucket"), flat("value"), flat("label").to_numpy(zero_copy_only=False)
    f = Features(
        np.concatenate([[0], np.cumsum(bucket.value_lengths().to_numpy())]),
        bucket.flatten().to_numpy().astype(np.int64),
        value.flatten().to_numpy().astype(np.float64),
        flat("structure").flatten().to_numpy().reshape(got.num_rows, -1),
    )
    del got, bucket, value
    # A fixed order of rows, so that the same sample gives the same model wherever it ran.
    keys = np.lexsort((f.structure[:, 0], f.structure[:, 7], f.start[1:] - f.start[:-1]))
    sizes = (f.start[1:] - f.start[:-1])[keys]
    start = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(start[-1]) + np.repeat(f.start[:-1][keys] - start[:-1], sizes)
    ordered = Features(start, f.bucket[at], f.value[at], f.structure[keys])
    return train(ordered, (label[keys] > 0).astype(float))


def score(docs: DataFrame, model: FactorModel | None, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability of label 1 to every row; null texts count as empty.

    A column called ``name`` in the input is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c.lower() != name.lower()]
    docs, place = docs.select(*others), others.index(text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def apply(batches):
        model, memo = shared.value, Memo(_bucket)
        for batch in batches:
            texts = texts_of(batch.column(place))
            if model is None:
                out = np.full(len(texts), 0.5)
            else:
                out = np.concatenate([np.zeros(0), *[scores(model, features(x, memo)) for x in _texts_by_slice(texts)]])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*others, name])

    return docs.mapInArrow(apply, f"{fields}, `{name}` double")

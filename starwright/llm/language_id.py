"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree: how often each symbol followed each
context of up to ``ORDER`` symbols in its training texts. A symbol's
probability comes from the longest context; what that context has not seen
gets its escape probability (method C: distinct symbols against all), shared
out by the next shorter context over the symbols not excluded. The statistics
are frozen, so every (context, symbol) has one exact code length, and a text's
code length in a language is a sum of table entries. The shortest code wins.

Training takes the ``sample_rows`` rows of each language whose ids hash lowest,
with their whole texts; that bound and the table sizes below are parameters of
the fit, and no others apply. Scoring reads whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwright.storage import written

from .common import runs, texts_of

ORDER = 3
#: Symbols of the folded alphabet; the last is shared by all bytes that are not frequent.
SYMBOLS = 64
#: Cells of a language's table of code lengths, over contexts and symbols.
CELLS = 1 << 21
#: Context counts of a language taken to the driver, the most frequent first.
MOST_COUNTS = 400_000
#: Bytes whose code lengths are looked up at once.
SLICE = 1 << 20
UNKNOWN = "und"


def _folded() -> bytes:
    """A-Z to a-z; other ASCII to a space; bytes of longer characters stay."""
    lower = bytes(range(256)).lower()
    return bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in lower)


FOLDED = _folded()


@dataclass
class LanguageModel:
    languages: list[str]
    symbol: np.ndarray  # of each byte
    state: list[np.ndarray]  # by language, of each context of ORDER symbols: the longest known suffix
    bits: list[np.ndarray]  # by language, code lengths: state * SYMBOLS + symbol


def _symbols(text: bytes, symbol: np.ndarray) -> np.ndarray:
    return symbol[np.frombuffer(text.translate(FOLDED), np.uint8)]


def _counter(symbol: np.ndarray):
    """Counts of (language, order, context, symbol), summed within each batch."""
    schema = "lang string, code long, n long"

    def count(batches):
        for batch in batches:
            languages = batch.column(0).to_pylist()
            texts = texts_of(batch.column(1))
            found: dict[str, list[bytes]] = {}
            for language, text in zip(languages, texts, strict=True):
                found.setdefault(language, []).append(b" " * ORDER + text)
            for language, parts in found.items():
                x = _symbols(b"".join(parts), symbol).astype(np.int64)
                for order in range(ORDER + 1):
                    code = np.full(len(x) - order, order, np.int64)
                    for k in range(order + 1):
                        code = code * SYMBOLS + x[k : len(x) - order + k]
                    codes, n = np.unique(code, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([language] * len(codes), pa.string()), pa.array(codes), pa.array(n.astype(np.int64))],
                        names=["lang", "code", "n"],
                    )

    return count, schema


def _histogram(batches):
    for batch in batches:
        total = np.zeros(256, np.int64)
        for text in texts_of(batch.column(1)):
            total += np.bincount(np.frombuffer(text.translate(FOLDED), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])


def _probabilities(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """PPM-C probabilities of one context's symbols for each row, given those of the shorter context."""
    seen = counts > 0
    total, distinct = counts.sum(1, keepdims=True), seen.sum(1, keepdims=True)
    left = np.where(seen, 0.0, shorter)
    room = left.sum(1, keepdims=True)
    full = room <= 0
    escape = np.where(full, 0, distinct)
    known = counts / np.maximum(total + escape, 1)
    unknown = left / np.where(full, 1, room) * (escape / np.maximum(total + escape, 1))
    return np.where(total == 0, shorter, np.where(seen, known, unknown))


def language_table(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A language's states and exact code lengths from its codes and their counts."""
    context, last = code // SYMBOLS, code % SYMBOLS
    # A context is kept as its order followed by its symbols, in base SYMBOLS.
    kept, where = np.unique(context, return_inverse=True)
    weight = np.bincount(where, weights=n, minlength=len(kept))
    best = np.sort(kept[np.argsort(-weight, kind="stable")[: CELLS // SYMBOLS]])
    at = np.searchsorted(best, context)
    inside = (at < len(best)) & (best[np.minimum(at, len(best) - 1)] == context)
    table = np.zeros((len(best), SYMBOLS))
    np.add.at(table, (at[inside], last[inside]), n[inside])

    order = np.zeros(len(best), np.int64)
    for k in range(1, ORDER + 1):
        order[best // SYMBOLS**k == k] = k
    # The state of the empty context is the base of the recursion, kept or not.
    longest = np.full(SYMBOLS**ORDER, -1, np.int64)
    p = np.empty_like(table)
    full = np.arange(SYMBOLS**ORDER)
    for k in range(ORDER + 1):
        mine = np.flatnonzero(order == k)
        if len(mine) == 0:
            continue
        own = best[mine] - k * SYMBOLS**k
        parent = longest[own] if k else np.full(len(mine), -1)  # by the suffix without the oldest symbol
        base = np.where((parent >= 0)[:, None], p[np.maximum(parent, 0)], 1.0 / SYMBOLS)
        p[mine] = _probabilities(table[mine], base)
        place = np.full(SYMBOLS**k, -1, np.int64)
        place[own] = mine
        found = place[full % SYMBOLS**k]
        longest = np.where(found >= 0, found, longest)
    if (longest < 0).any():
        p = np.concatenate([p, np.full((1, SYMBOLS), 1.0 / SYMBOLS)])
        longest[longest < 0] = len(p) - 1
    return longest.astype(np.int32), -np.log2(p).ravel().astype(np.float32)


def fit(labelled: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id", sample_rows: int = 500) -> LanguageModel:
    """Learn from whole texts of up to ``sample_rows`` rows of each language.

    Rows whose text, language or key is null are left out. Without any row the
    model has no language.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull())
    rows = rows.select(F.col(language).alias("lang"), F.col(key).alias("id"), F.col(text).alias("text"))
    ids = rows.where(F.col("id").isNotNull()).select("lang", "id")
    sizes = written(ids.groupBy("lang").agg(F.approx_count_distinct("id").alias("n")), "language-sizes")
    # The lowest hashes are chosen; of a frequent language, rows far above them need not be sorted.
    place = F.xxhash64("id") / F.lit(2.0**64) + 0.5
    low = ids.join(sizes, "lang").where(place * F.col("n") <= 4 * sample_rows).select("lang", "id").distinct()
    by = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = low.withColumn("k", F.row_number().over(by)).where(F.col("k") <= sample_rows)
    chosen = written(chosen.select("lang", "id"), "language-ids")
    sample = written(rows.join(chosen, ["lang", "id"], "left_semi").select("lang", "text"), "language-sample")
    languages = sorted(r[0] for r in chosen.select("lang").distinct().collect())
    frequent = sample.mapInArrow(_histogram, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    ranked = sorted((r for r in frequent if r["n"]), key=lambda r: (-r["n"], r["byte"]))[: SYMBOLS - 1]
    symbol = np.full(256, SYMBOLS - 1, np.uint8)
    for i, r in enumerate(ranked):
        symbol[r["byte"]] = i
    count, schema = _counter(symbol)
    model = LanguageModel(languages, symbol, [], [])
    if languages:
        counts = written(sample.mapInArrow(count, schema).groupBy("lang", "code").agg(F.sum("n").alias("n")), "language-counts")
    for name in languages:
        found = counts.where(F.col("lang") == name).select("code", "n").orderBy(F.desc("n"), "code").limit(MOST_COUNTS).toArrow()
        state, bits = language_table(found.column("code").to_numpy(), found.column("n").to_numpy().astype(np.float64))
        model.state.append(state)
        model.bits.append(bits)
    return model


def code_lengths(model: LanguageModel, texts: list[bytes]) -> np.ndarray:
    """Bits of each text in each language."""
    total = np.zeros((len(texts), len(model.languages)))
    pieces = [(i, start, min(len(t), start + SLICE)) for i, t in enumerate(texts) for start in range(0, len(t), SLICE)]
    for a, b in runs((end - start for _, start, end in pieces), SLICE):
        part = pieces[a:b]
        data = b"".join((b" " * ORDER + texts[i][max(0, s - ORDER) : s])[-ORDER:] + texts[i][s:e] for i, s, e in part)
        x = _symbols(data, model.symbol).astype(np.int32)
        context = (x[:-3] * SYMBOLS + x[1:-2]) * SYMBOLS + x[2:-1]
        bits = np.empty((len(context), len(model.languages)), np.float32)
        for i, (state, table) in enumerate(zip(model.state, model.bits, strict=True)):
            bits[:, i] = table[state[context] * SYMBOLS + x[3:]]
        sizes = np.array([e - s + ORDER for _, s, e in part])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        # Between a piece's own entries and the next piece's lie ORDER entries that belong to neither.
        bounds = np.stack([starts, starts + sizes - ORDER], 1).ravel()
        sums = np.add.reduceat(np.concatenate([bits, np.zeros((ORDER, bits.shape[1]), bits.dtype)]), bounds, axis=0, dtype=np.float64)
        np.add.at(total, [i for i, _, _ in part], sums[::2])
    return total


#: A longer text is no surer than one of so many bytes: neighbouring symbols are not independent.
SURE_BYTES = 256


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``bits_per_byte`` to every row.

    Languages with equal code lengths: the first by name. ``score`` is the
    winner's share when code lengths are read as probabilities, each text
    counted as ``SURE_BYTES`` bytes at most. Text that is null or has no
    letter, or a model without languages: ``und`` with score 0 and null bits.
    Columns of these names in the input are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "bits_per_byte", "_spoken")]
    docs = docs.select(*others, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_spoken"))
    place = others.index(text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "_spoken")

    def score(batches):
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            texts = texts_of(batch.column(place))
            spoken = np.array(batch.column(batch.num_columns - 1).to_pylist(), bool)
            best = np.full(len(texts), len(model.languages))
            sure, bits = np.zeros(len(texts)), np.full(len(texts), np.nan)
            if model.languages:
                total = code_lengths(model, texts)
                size = np.maximum([len(t) for t in texts], 1)
                first = total.argmin(1)
                least = total[np.arange(len(texts)), first]
                share = np.exp2(-np.minimum((total - least[:, None]) * np.minimum(1, SURE_BYTES / size)[:, None], 1000))
                best = np.where(spoken, first, best)
                sure = np.where(spoken, 1 / share.sum(1), 0.0)
                bits = np.where(spoken, least / size, np.nan)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[best], pa.string()), pa.array(sure), pa.array(bits, mask=np.isnan(bits))],
                names=[*others, "lang_pred", "score", "bits_per_byte"],
            )

    return docs.mapInArrow(score, f"{fields}, lang_pred string, score double, bits_per_byte double")


def known_language(least_score: float = 0.5) -> Column:
    """Whether a predicted row is kept by a filter: some language, and surely enough."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)

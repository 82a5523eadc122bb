"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut in halves; each half has a codebook of its own, and a pair
of codes is a cell of the product grid. A vector visits cells in order of the
summed distances of its halves to the codes: the multi-sequence traversal, a
heap over the two sorted lists of distances that stops after as many cells as
neighbours need for the target recall. What it meets there is verified by its
cosine in double precision.

The codebooks and the number of visits are fitted on at most ``SAMPLE`` vectors
of a dimension, for made neighbours at the threshold and for those that the
sample itself holds; every vector is indexed and visits. The codebooks grow with
the number of vectors. One rule gives the visits of all tables: all links within
the sample are met, so where it is the table none is lost. Equal vectors of a label are one class. A cell of one label is dealt out
in blocks of ``BLOCK`` members against ``BLOCK`` visitors, each a task's matrix
product whose links are summed and contracted there, so a hot cell is split and
its pairs are never listed.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.storage import written

from .components import components

LEAST_COSINE = 0.93
#: Codes of a half: so many at least, and for large tables as many as make cells of ``CELL`` vectors.
CODES = 16
CELL = 256
SAMPLE = 4000
#: Sample vectors that a code needs to be fitted to.
PER_CODE = 8
TARGET_RECALL = 0.99
BLOCK = 1024
ROUNDS = 15


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1)


def _codebook(x: np.ndarray, number: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centres; fewer than ``number`` distinct vectors give fewer."""
    x = np.unique(x, axis=0)
    codes = x[rng.choice(len(x), min(number, len(x)), replace=False)]
    for _ in range(ROUNDS):
        own = _distances(x, codes).argmin(1)
        n = np.bincount(own, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, own, x)
        codes = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], codes)
    return codes


def _traversal(a: list[float], b: list[float], number: int) -> list[tuple[int, int]]:
    """The first ``number`` pairs of places in two ascending lists, by ascending sum."""
    out, heap, reached = [], [(a[0] + b[0], 0, 0)], [0] * len(a)
    while heap and len(out) < number:
        _, i, j = heapq.heappop(heap)
        out.append((i, j))
        # A pair comes up when the ones left of it and above it have been taken.
        reached[i] = j + 1
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return out


Books = tuple[np.ndarray, np.ndarray]


def _homes(x: np.ndarray, books: Books) -> np.ndarray:
    """Each row's own cell."""
    half = books[0].shape[1]
    return _distances(x[:, :half], books[0]).argmin(1) * len(books[1]) + _distances(x[:, half:], books[1]).argmin(1)


def _visits(x: np.ndarray, books: Books, number: int) -> np.ndarray:
    """The ``number`` cells that each row visits, nearest first."""
    half, width = books[0].shape[1], len(books[1])
    if number >= len(books[0]) * width:
        return np.broadcast_to(np.arange(len(books[0]) * width), (len(x), len(books[0]) * width))
    near = [_distances(x[:, :half], books[0]), _distances(x[:, half:], books[1])]
    order = [d.argsort(1, kind="stable") for d in near]
    ascending = [np.take_along_axis(d, o, 1) for d, o in zip(near, order, strict=True)]
    out = np.empty((len(x), number), np.int64)
    for row, (a, b) in enumerate(zip(*(d.tolist() for d in ascending), strict=True)):
        places = np.array(_traversal(a, b, number))
        out[row] = order[0][row][places[:, 0]] * width + order[1][row][places[:, 1]]
    return out


#: Distances, of rows to cells, that the driver holds at once.
GRID = 1 << 22
#: What distances and cosines that are computed in other batches may differ by.
ROUNDING = 1e-9


def _ranks(x: np.ndarray, books: Books, homes: np.ndarray, links) -> np.ndarray:
    """For each row of ``x``, how many cells it visits until it has seen those of all its neighbours.

    ``links`` gives, for a slice of the rows, which of the vectors of the cells ``homes`` are
    neighbours. Rows without any are left out.
    """
    half, out = books[0].shape[1], []
    step = max(1, GRID // max(len(books[0]) * len(books[1]), len(homes)))
    for i in range(0, len(x), step):
        part = x[i : i + step]
        grid = _distances(part[:, :half], books[0])[:, :, None] + _distances(part[:, half:], books[1])[:, None, :]
        grid = grid.reshape(len(part), -1)
        near = links(slice(i, i + step))
        farthest = np.where(near, grid[:, homes], -np.inf).max(1, initial=-np.inf)
        out.append((grid <= farthest[:, None] + ROUNDING).sum(1)[near.any(1)])
    return np.concatenate([np.zeros(0, np.int64), *out])


def _fit(x: np.ndarray, number: int, rng: np.random.Generator) -> tuple[Books, int]:
    """Codebooks of both halves for ``number`` vectors, of which ``x`` is a sample, and how many cells to visit.

    So many that every row of the sample meets all its neighbours there, and all but a few rows
    one that is made at the threshold. Where the sample is the table, no link is lost.
    """
    half = x.shape[1] // 2
    wanted = min(max(CODES, int(np.ceil(np.sqrt(number / CELL)))), max(CODES, len(x) // PER_CODE))
    books = (_codebook(x[:, :half], wanted, rng), _codebook(x[:, half:], wanted, rng))
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.maximum(np.sqrt((noise * noise).sum(1, keepdims=True)), 1e-12)
    made = LEAST_COSINE * x + np.sqrt(1 - LEAST_COSINE**2) * noise
    place = np.arange(len(x))
    to_made = _ranks(x, books, _homes(made, books), lambda rows: place[rows, None] == place)
    to_found = _ranks(x, books, _homes(x, books), lambda rows: x[rows] @ x.T >= LEAST_COSINE - ROUNDING)
    needed = max(float(np.quantile(to_made, TARGET_RECALL)), float(to_found.max()))
    return books, int(min(len(books[0]) * len(books[1]), np.ceil(needed)))


def _classes(rows: DataFrame) -> DataFrame:
    """(id, label, dim, sig, vec) of every row; only ids of rows that cannot be linked.

    A vector's 32- or 64-bit components are read as doubles.
    """

    def read(batches):
        for batch in batches:
            labels, dims, sigs, vecs = [], [], [], []
            for label, v in zip(*(batch.column(k).to_pylist() for k in (1, 2)), strict=True):
                x = np.array([], np.float64) if label is None or not v or None in v else np.array(v, np.float64)
                if not np.isfinite(x).all() or not (x != 0).any():
                    for column in (labels, dims, sigs, vecs):
                        column.append(None)
                    continue
                x = x / np.abs(x).max()
                labels.append(str(label))
                dims.append(len(x))
                sigs.append(xxhash.xxh3_128_digest(np.array(v, np.float64).tobytes()))
                vecs.append((x / np.sqrt((x * x).sum())).tobytes())
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, k) for x, k in zip((labels, dims, sigs, vecs), kinds, strict=True))],
                names=["id", "label", "dim", "sig", "vec"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(read, f"id {kind}, label string, dim int, sig binary, vec binary")


def _cells(classes: DataFrame, models) -> DataFrame:
    def assign(batches):
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist())
            vecs = batch.column("vec").to_pylist()
            home, visits = np.zeros(len(dims), np.int32), [None] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                books, number = models.value[int(dim)]
                x = np.stack([np.frombuffer(vecs[i]) for i in at])
                home[at], seen = _homes(x, books), _visits(x, books, number)
                for i, s in zip(at, seen, strict=True):
                    visits[i] = s.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(visits, pa.list_(pa.int32()))], names=[*batch.schema.names, "cell", "visits"]
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(assign, f"{fields}, cell int, visits array<int>")


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node that links lead to, of each of n nodes."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def _meet(table: pa.Table) -> pa.Table:
    """Links of a block's visitors with its members: for each id the weight linked, and an id it hangs on."""
    visitor = np.array(table.column("visitor").to_pylist(), bool)
    ids = table.column("cls").to_pylist()
    weight = np.array(table.column("weight").to_pylist(), np.int64)
    home = np.array(table.column("home").to_pylist(), np.int64)
    vecs, visits = table.column("vec").to_pylist(), table.column("visits").to_pylist()
    index = {x: i for i, x in enumerate(dict.fromkeys(ids))}
    node = np.array([index[x] for x in ids], np.int64)
    p, m = np.flatnonzero(visitor), np.flatnonzero(~visitor)
    gained = np.zeros(len(index), np.int64)
    root = np.arange(len(index))
    if len(p) and len(m):
        x = np.stack([np.frombuffer(vecs[i]) for i in p]) @ np.stack([np.frombuffer(vecs[i]) for i in m]).T
        i, j = np.nonzero(x >= LEAST_COSINE)
        i, j = p[i], m[j]
        other = node[i] != node[j]
        i, j = i[other], j[other]
        np.add.at(gained, node[i], weight[j])
        # A member that does not visit the visitor's cell learns of the link here only.
        homes = np.unique(home[p])
        seen = np.zeros((len(ids), len(homes)), bool)
        for k in m:
            seen[k] = np.isin(homes, visits[k])
        unseen = ~seen[j, np.searchsorted(homes, home[i])]
        np.add.at(gained, node[j][unseen], weight[i][unseen])
        root = _roots(node[i], node[j], len(index))
    names = list(index)
    some = np.flatnonzero((gained > 0) | (root != np.arange(len(index))))
    return pa.table(
        {
            "cls": pa.array([names[k] for k in some], pa.int64()),
            "n": pa.array(gained[some], pa.int64()),
            "hangs": pa.array([names[root[k]] for k in some], pa.int64()),
        }
    )


def duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every input row.

    ``n_links`` counts the other rows linked directly, equal vectors among
    them. Rows without a label or with a vector that is null, empty, zero or has
    null or non-finite components are linked with nothing, as are vectors of
    different lengths. Rows with a null id stand for themselves only. Rows that
    share an id are rows of their own, each linked by its own vector.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vec"))
    read = written(_classes(rows), "vectors")
    by = ["label", "dim", "sig"]
    sized = read.where("id IS NOT NULL AND sig IS NOT NULL").groupBy(*by)
    sized = sized.agg(F.min("id").alias("rep"), F.count("*").alias("weight"), F.first("vec").alias("vec"))
    classes = written(sized.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    rng, models = np.random.default_rng(seed), {}
    for dim, number in sorted(classes.groupBy("dim").count().collect()):
        sample = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("sig", "label"), "rep").limit(SAMPLE).select("vec").collect()
        models[dim] = _fit(np.stack([np.frombuffer(r["vec"]) for r in sample]), number, rng)
    placed = written(_cells(classes.drop("sig", "rep"), spark.sparkContext.broadcast(models)), "cells")
    at = ["label", "dim", "cell"]
    columns = [*at, "cls", "weight", "vec", "home", "visits"]
    members = placed.withColumn("home", F.col("cell")).select(*columns)
    visitors = placed.withColumnRenamed("cell", "home").withColumn("cell", F.explode("visits")).select(*columns)
    # How many blocks each side of a cell is dealt into; cells without members meet nobody.
    blocks = F.ceil(F.count("*") / BLOCK).cast("int")
    ms = members.groupBy(*at).agg(blocks.alias("ms"))
    qs = visitors.groupBy(*at).agg(blocks.alias("qs"))
    dealt = written(ms.join(qs, at), "cell-blocks")
    mine = lambda k: F.pmod(F.xxhash64("cls"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    one = members.join(dealt, at).withColumn("m", mine("ms")).withColumn("q", every("qs")).withColumn("visitor", F.lit(False))
    two = visitors.join(dealt, at).withColumn("q", mine("qs")).withColumn("m", every("ms")).withColumn("visitor", F.lit(True))
    met = one.unionByName(two).drop("ms", "qs").groupBy(*at, "m", "q").applyInArrow(_meet, "cls long, n long, hangs long")
    met = written(met, "met")
    gained = met.groupBy("cls").agg(F.sum("n").alias("gained"))
    found = components(met.select(F.col("cls").alias("a"), F.col("hangs").alias("b"))).withColumnRenamed("node", "cls")
    known = classes.select(*by, "cls", "rep", "weight").join(gained, "cls", "left").join(found, "cls", "left")
    known = written(known.withColumn("component", F.coalesce("component", "cls")), "linked-classes")
    least = known.groupBy("component").agg(F.min("rep").alias("least"))
    known = known.join(least, "component").select(
        *[F.col(c).alias(f"_{c}") for c in by],
        (F.col("weight") - 1 + F.coalesce("gained", F.lit(0))).alias("n"),
        "least",
    )
    same = [F.col(c) == F.col(f"_{c}") for c in by]
    # Rows that cannot be linked have no signature and find no class; null ids are in none.
    out = read.join(written(known, "known-classes"), [*same, F.col("id").isNotNull()], "left")
    component = F.coalesce("least", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )

"""Removal of lines that many documents repeat, by levelled sorted runs of line hashes.

Documents come in batches, greatest ids first. The index is a set of runs:
tables of (line hash, owner, number of documents), sorted and bucketed by hash,
with one row for each line. A batch folds its own lines, merge-anti-joins the
runs for lines that are settled there (found in enough documents, so that
nothing later can change them), and adds the rest as a run of its own. When a
level holds ``FANOUT`` runs they are merged into one run of the next level, where
owners keep the greatest id and numbers add up; so a line is rewritten once for
each level. Runs and batches are bucketed alike: a join sorts a batch into the
buckets and reads the runs as they lie.

The owner of a line is the greatest id that holds it. When all batches are in,
a last merge tells the lines of enough documents, which are dropped everywhere
but in their owner.

Defined cases: null and empty texts are one empty line. A text of which all
lines are dropped becomes empty. Rows with one id count as one document, and
rows without an id as one that is smaller than all others. Equal rows give equal
results, each its own. An empty table gives no rows. Other columns stay;
``n_lines``, ``n_dropped`` and ``kept`` are replaced if there.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.storage import remove, scratch_dir, written

from .common import distinct_name

LEAST_CHARACTERS = 20
LEAST_DOCUMENTS = 3
#: Runs of a level that are merged into one of the next.
FANOUT = 2
BATCHES = 6
#: Lines that a bucket of a run is meant for; there are as many buckets as shuffle partitions at least.
BUCKET_LINES = 2_000_000
#: What a line is known by: 128 bits of its key.
KEY = ["h1", "h2"]
#: The id of rows that have none.
NO_ID = -(1 << 63)
_STRIPPED = b" \t\n\v\f\r"


def line_key(line: bytes) -> bytes | None:
    """A line stripped of white space and with A-Z in lower case; None if it is too short to count."""
    key = line.strip(_STRIPPED).lower()
    if len(key) < LEAST_CHARACTERS:
        return None
    if len(key) < 4 * LEAST_CHARACTERS and len(key.decode("utf-8", "replace")) < LEAST_CHARACTERS:
        return None
    return key


def _hashes(text: bytes) -> dict[bytes, list[int]]:
    """The lines of a text that count, by hash, with the places they stand at."""
    places: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.split(b"\n")):
        key = line_key(line)
        if key is not None:
            places.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
    return places


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def lines_of(docs: DataFrame) -> DataFrame:
    """(id, row, h1, h2, places): each line that counts, once for each row of (id, row, text)."""

    def apply(batches):
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out_id, out_row, keys, places = [], [], [], []
            for doc, row, text in zip(ids, rows, _bytes_of(batch.column(2))):
                found = _hashes(text)
                out_id += [doc] * len(found)
                out_row += [row] * len(found)
                keys += found
                places += found.values()
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out_id, pa.int64()),
                    pa.array(out_row, pa.int64()),
                    pa.array(halves[:, 0].copy(), pa.int64()),
                    pa.array(halves[:, 1].copy(), pa.int64()),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                names=["id", "row", "h1", "h2", "places"],
            )

    return docs.mapInArrow(apply, "id long, row long, h1 long, h2 long, places array<int>")


class LineRuns:
    """The index of lines seen so far: levels of sorted runs in the shared folder.

    Batches must come in descending order of id, and an id's rows in one batch.
    """

    def __init__(self, spark: SparkSession, buckets: int, least: int = LEAST_DOCUMENTS, fanout: int = FANOUT):
        self.spark, self.buckets, self.least, self.fanout = spark, buckets, least, fanout
        self.levels: list[list[str]] = []
        self.folder = scratch_dir(spark, "line-runs")

    def _write(self, rows: DataFrame) -> str:
        """A run of rows that lie in the buckets already."""
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        remove(self.spark, f"{self.folder}/{name}")

    def _merged(self, names: list[str]) -> DataFrame:
        """The rows of several runs as one: full merge joins, bucket by bucket and without a shuffle.

        A run has each line once, so no bucket is hot. (A union of bucketed
        scans passes for bucketed as well, but then counts a line of two runs twice.)
        """
        rows = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select(*KEY, F.col("owner").alias("_owner"), F.col("n").alias("_n"))
            joined = rows.join(other.hint("merge"), KEY, "full")
            number = F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))
            rows = joined.select(*KEY, F.greatest("owner", "_owner").alias("owner"), number.alias("n"))
        return rows

    def add(self, lines: DataFrame) -> None:
        """Take in a batch of (id, h1, h2), which may repeat.

        The batch is folded and written before it meets the runs: an anti-join
        would otherwise be moved below the folding, where a line that a third
        of all rows hold is still that many rows.
        """
        new = lines.groupBy(*KEY).agg(F.max("id").alias("owner"), F.count_distinct("id").alias("n"))
        new = written(new, "line-batch").repartition(self.buckets, *KEY)
        for name in [x for level in self.levels for x in level]:
            settled = self.spark.table(name).where(F.col("n") >= self.least).select(*KEY)
            new = new.join(settled.hint("merge"), KEY, "left_anti")
        self._place(self._write(new), 0)

    def _place(self, name: str, level: int) -> None:
        """Put a run on a level; a full level becomes one run of the next."""
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            merged = self._write(self._merged(runs))
            for run in runs:
                self._drop(run)
            self._place(merged, level + 1)

    def repeated(self) -> DataFrame:
        """(h1, h2, owner) of the lines in enough documents. The runs are merged and removed."""
        runs = [x for level in self.levels for x in level]
        if not runs:
            return self.spark.createDataFrame([], "h1 long, h2 long, owner long")
        many = written(self._merged(runs).where(F.col("n") >= self.least).select(*KEY, "owner"), "repeated-lines")
        for run in runs:
            self._drop(run)
        self.levels = []
        return many


def _batch(ids: DataFrame, batches: int) -> Column:
    """Which batch an id is in, greatest ids first, by quantiles of the ids."""
    shares = [i / batches for i in range(1, batches)]
    bounds = ids.agg(F.percentile_approx("id", shares, 1000).alias("b")).first()["b"] or []
    # Batches after the first begin below a bound; equal bounds leave a batch empty.
    return sum(((F.col("id") <= b).cast("int") for b in bounds), F.lit(0))


def dedup(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Add ``n_lines``, ``n_dropped`` and ``kept``, the text without its repeated lines.

    Texts are split where they are read. Only hashes go into the index; what
    comes back to a text are the places of the lines to drop.
    """
    spark = docs.sparkSession
    taken = ("n_lines", "n_dropped", "kept")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in taken])
    own, row = distinct_name("_own", docs.columns), distinct_name("_row", docs.columns)
    keyed = docs.withColumns(
        {own: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), row: F.xxhash64("text", F.length("text"))}
    )
    lines = lines_of(keyed.select(F.col(own).alias("id"), F.col(row).alias("row"), "text"))
    lines = lines.withColumn("batch", _batch(keyed.select(F.col(own).alias("id")), batches))
    path = scratch_dir(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)

    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines.count() // BUCKET_LINES))
    index = LineRuns(spark, buckets, fanout=fanout)
    for batch in range(batches):
        index.add(lines.where(F.col("batch") == batch).select("id", *KEY))
    drops = lines.join(index.repeated(), KEY).where("id != owner")
    # A row's lines are a bounded group: those of one text. Equal rows give the same places twice.
    drops = drops.groupBy("id", "row").agg(F.flatten(F.collect_set("places")).alias("places"))
    drops = written(drops, "dropped-lines")
    drops = drops.select(F.col("id").alias(own), F.col("row").alias(row), F.col("places").alias("_places"))
    return _without(keyed.join(drops, [own, row], "left").drop(own, row))


def _without(docs: DataFrame) -> DataFrame:
    """Cut the lines at ``_places`` out of every text."""
    *others, _ = docs.columns
    text = others.index("text")
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)

    def apply(batches):
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for value, places in zip(_bytes_of(batch.column(text)), batch.column(batch.num_columns - 1).to_pylist()):
                lines = value.split(b"\n")
                drop = set(places or ())
                n_lines.append(len(lines))
                n_dropped.append(len(drop))
                kept.append(b"\n".join([x for i, x in enumerate(lines) if i not in drop]) if drop else value)
            added = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=[*others, "n_lines", "n_dropped", "kept"])

    return docs.mapInArrow(apply, f"{fields}, n_lines long, n_dropped long, kept string")

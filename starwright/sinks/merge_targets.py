"""Tables that batches are merged into, laid out so that a batch touches what it must.

A merge target is a parquet table partitioned by ``key_bucket``, a hash of its
key columns. A batch finds the buckets of its own keys; only those are read, and
an update overwrites only those, so the files of all other buckets stay as they
are. The number of buckets is fixed when the table is made, which also bounds
the list of touched buckets that the driver holds.

Inserts that keep existing rows need no row of the target at all. A ledger
beside the table holds two 64-bit hashes of each key, in the same buckets; a
batch anti-joins the hashes of its buckets and appends. While target and ledger
disagree, between the two writes, the table says so in a property; whoever
finds that left behind by a lost run restores the ledger from the target's keys.

Buckets suit tables with one row for each key. A hot key of the batch folds to
one row before it meets them, so no bucket is hot.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.functions.keys import require_keys
from starwright.operators.dimensions import first_per_key
from starwright.operators.merges import merged_rows
from starwright.sinks.files import laid_out
from starwright.storage import written

BUCKET = "key_bucket"
BUCKETS = 64
LEDGER = "__keys"
# Table properties.
KEYS_PROPERTY = "starwright.merge.keys"
BUCKETS_PROPERTY = "starwright.merge.buckets"
NULLS_PROPERTY = "starwright.merge.null-keys"
#: Whether the ledger holds the keys of all rows: "yes", "writing", or absent without a ledger.
LEDGER_PROPERTY = "starwright.merge.ledger"
_DIGEST = ["h1", "h2"]


def ledger_name(table: str) -> str:
    """The name of a table's ledger; ``db.t`` and ``db.`t` `` alike."""
    return f"{table[:-1]}{LEDGER}`" if table.endswith("`") else f"{table}{LEDGER}"


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_property(spark: SparkSession, table: str, name: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{value}')")


def create_merge_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    keys: Sequence[str],
    *,
    buckets: int = BUCKETS,
    ledger: bool = True,
    null_keys: bool = False,
) -> None:
    """Create a merge target if it does not exist.

    ``ledger`` keeps hashes of the keys for inserts that ignore known ones.
    With ``null_keys`` a null is a value of a key like any other (all columns
    may then be the key, and rows are merged as a set); without, it is an error.
    """
    if null_keys and not ledger:
        raise ValueError("only a ledger of hashes can tell keys with nulls")
    described = {KEYS_PROPERTY: ",".join(keys), BUCKETS_PROPERTY: buckets, NULLS_PROPERTY: "yes" if null_keys else "no"}
    if ledger:
        described[LEDGER_PROPERTY] = "yes"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {ledger_name(table)} (h1 BIGINT, h2 BIGINT, {BUCKET} INT) "
            f"USING parquet PARTITIONED BY ({BUCKET})"
        )
    listed = ", ".join(f"'{name}' = '{value}'" for name, value in described.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema.toDDL()}, {BUCKET} INT) "
        f"USING parquet PARTITIONED BY ({BUCKET}) TBLPROPERTIES ({listed})"
    )


class MergeTarget:
    """A merge target as its properties describe it."""

    def __init__(self, spark: SparkSession, table: str, described: dict[str, str] | None = None):
        found = properties(spark, table) if described is None else described
        if BUCKETS_PROPERTY not in found:
            raise ValueError(f"{table} is no merge target")
        self.spark, self.table = spark, table
        self.keys = found[KEYS_PROPERTY].split(",")
        self.buckets = int(found[BUCKETS_PROPERTY])
        self.null_keys = found.get(NULLS_PROPERTY) == "yes"
        self.ledger_state = found.get(LEDGER_PROPERTY)
        self.schema = T.StructType([f for f in spark.table(table).schema.fields if f.name != BUCKET])

    def rows(self, touched: Sequence[int] | None = None) -> DataFrame:
        """The table without its bucket column; of the given buckets only."""
        return self._of(self.table, touched).select(*self.schema.names)

    def _of(self, table: str, touched: Sequence[int] | None) -> DataFrame:
        stored = self.spark.table(table)
        return stored if touched is None else stored.where(F.col(BUCKET).isin(*touched))

    def _stored(self, table: str, touched: Sequence[int]) -> list[int]:
        """Those of the buckets that the table has, by its catalog entry."""
        listed = self.spark.sql(f"SHOW PARTITIONS {table}").collect()
        return sorted({int(row["partition"].split("=")[1]) for row in listed} & set(touched))

    def _hash(self, seed: int) -> Column:
        """A hash of the key; which columns are null is part of it."""
        keys = [F.col(k) for k in self.keys]
        nulls = [k.isNull() for k in keys] if self.null_keys else []
        return F.xxhash64(F.lit(seed), *nulls, *keys)

    def bucket(self) -> Column:
        return F.pmod(self._hash(0), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def digests(self, rows: DataFrame) -> DataFrame:
        return rows.select(self._hash(1).alias("h1"), self._hash(2).alias("h2"), self.bucket())

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of a batch's keys: as many as the table has, at most."""
        return sorted(row[BUCKET] for row in rows.select(self.bucket()).distinct().collect())

    def _kept(self, rows: DataFrame, label: str) -> tuple[DataFrame, list[int]]:
        """A batch written once, and the buckets of its keys, which the write itself reports."""
        seen = Observation(f"{label}-{uuid.uuid4().hex}")
        kept = written(rows.observe(seen, F.collect_set(self.bucket()).alias("buckets")), label)
        return kept, sorted(seen.get["buckets"])

    def typed(self, new: DataFrame) -> DataFrame:
        """The new rows with key columns of the target's types, so that equal keys hash alike."""
        casts = {k: F.col(k).cast(self.schema[k].dataType) for k in self.keys}
        rows = new.withColumns(casts)
        return rows if self.null_keys else require_keys(rows, self.keys)

    def unknown(self, first: DataFrame, touched: Sequence[int]) -> DataFrame:
        """Rows, one for each key, whose keys the ledger does not hold."""
        hashed = first.withColumns({"_h1": self._hash(1), "_h2": self._hash(2)})
        known = self._of(ledger_name(self.table), touched).select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
        return hashed.join(known, ["_h1", "_h2"], "left_anti").drop("_h1", "_h2")

    def restore_ledger(self) -> None:
        """Write the ledger anew from the keys of the target."""
        keys = self.digests(self.rows().select(*self.keys)).distinct()
        laid_out(keys, [BUCKET]).write.insertInto(ledger_name(self.table), overwrite=True)
        set_property(self.spark, self.table, LEDGER_PROPERTY, "yes")
        self.ledger_state = "yes"

    @contextmanager
    def _both(self) -> Iterator[None]:
        """Target and ledger change together, or the next batch restores the ledger."""
        set_property(self.spark, self.table, LEDGER_PROPERTY, "writing")
        yield
        set_property(self.spark, self.table, LEDGER_PROPERTY, "yes")

    def _append(self, rows: DataFrame) -> None:
        laid_out(rows.select(*self.schema.names, self.bucket()), [BUCKET]).write.insertInto(self.table)

    def _note(self, rows: DataFrame) -> None:
        laid_out(self.digests(rows), [BUCKET]).write.insertInto(ledger_name(self.table))

    def insert_new(self, new: DataFrame, order: Sequence[str]) -> None:
        """Add the first row of each key that is not there yet; on conflict do nothing."""
        rows = self.typed(new)
        if self.ledger_state == "writing":
            self.restore_ledger()
        if self.null_keys and set(self.keys) >= set(self.schema.names):
            first = rows.select(*self.schema.names).distinct()
        else:
            first = first_per_key(rows, self.keys, order, self.schema.names)
        first, touched = self._kept(first, "merge-batch")
        if not touched:
            return
        if self.ledger_state is None:
            known = self.rows(touched).select(*self.keys)
            self._append(first.join(known, self.keys, "left_anti"))
            return
        held = self._stored(ledger_name(self.table), touched)
        fresh = written(self.unknown(first, held), "merge-fresh") if held else first
        with self._both():
            self._append(fresh)
            self._note(fresh)

    def update(self, new: DataFrame, order: Sequence[str], columns: Sequence[str]) -> None:
        """Insert rows with new keys; on conflict set ``columns``. Other buckets are not rewritten."""
        if self.null_keys:
            raise ValueError("updates need keys without nulls")
        rows = self.typed(new)
        if self.ledger_state == "writing":
            self.restore_ledger()
        rows, touched = self._kept(rows, "merge-batch")
        if not touched:
            return
        held = self._stored(self.table, touched)
        before = self.rows(held) if held else None
        merged = merged_rows(before, rows, self.keys, order, self.schema.names, columns)
        if self.ledger_state is None:
            self._replace(merged)
            return
        keys = rows.select(*self.keys).distinct()
        fresh = written(self.unknown(keys, touched), "merge-fresh")
        with self._both():
            self._replace(merged)
            self._note(fresh)

    def _replace(self, merged: DataFrame) -> None:
        """Overwrite the buckets that the rows are in; their old files go when all rows are written."""
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            rows = merged.select(*self.schema.names, self.bucket())
            laid_out(rows, [BUCKET]).write.insertInto(self.table, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)

    def compact(self, touched: Sequence[int] | None = None) -> None:
        """Rewrite buckets that many small appends have filled, each into few files."""
        self._replace(self.rows(touched))


def merge_target(spark: SparkSession, table: str) -> MergeTarget | None:
    """The merge target of that name, or None if the table is a plain one."""
    described = properties(spark, table)
    return MergeTarget(spark, table, described) if BUCKETS_PROPERTY in described else None


def contents(spark: SparkSession, table: str) -> DataFrame:
    """A table's rows, without the bucket column of a merge target."""
    return spark.table(table).drop(BUCKET)

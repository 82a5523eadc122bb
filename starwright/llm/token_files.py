"""Counting documents and tokens in flat token files.

A flat file is nothing but token ids of 16 or 32 bits, little-endian, with an
end-of-document id after each document and no index. Files are read in blocks
of ``BLOCK`` bytes, wherever documents begin. A block finds its separators by
one vectorised comparison. A document that spans blocks is stitched by a prefix
scan over the blocks of its file: each block passes on the tokens since its last
separator, or all it was passed and holds if it has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starwright.storage import written

BLOCK = 8 << 20
#: Blocks whose sums one task scans before sums of sums are scanned.
GROUP = 1 << 10


def write(tokens: DataFrame, path: str, separator: int, column: str = "ids") -> None:
    """Write documents' packed 16-bit ids as flat files, each followed by the separator.

    The text sink writes a value's bytes and the separator as they are, and
    commits files like any other: a task that runs again leaves no half file.
    """
    end = separator.to_bytes(2, "little").decode("latin-1")
    tokens.select(F.col(column).cast("string").alias("value")).write.option("lineSep", end).option("encoding", "ISO-8859-1").text(path)


def _blocks(spark: SparkSession, path: str, size: int) -> DataFrame:
    """(file, block, start, length): which bytes to read. File contents are not."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "length").where("length > 0")
    blocks = files.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size))))
    return blocks.select("file", "block", (F.col("block") * size).alias("start"), F.least(F.lit(size), F.col("length") - F.col("block") * size).alias("bytes"))


def _read(separator: int, width: int):
    kind = np.dtype(f"<u{width}")

    def scan(batches):
        for batch in batches:
            for file, block, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, place = pa.fs.FileSystem.from_uri(file)
                with system.open_input_file(place) as source:
                    data = source.read_at(size, start)
                if len(data) != size or size % width:
                    raise ValueError(f"{file}: {len(data)} bytes at {start}, not whole tokens")
                ends = np.flatnonzero(np.frombuffer(data, kind) == separator)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block]), pa.array([size // width]), pa.array([ends], pa.list_(pa.int64()))],
                    names=["file", "block", "n", "ends"],
                )

    return scan


def count(spark: SparkSession, path: str, separator: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(file, doc_index, start, n_tokens) of every document, separators not counted.

    ``start`` is the position of a document's first token in its file. Tokens
    after a file's last separator are one more document; empty files and
    folders have none.
    """
    blocks = _blocks(spark, path, block // width * width).repartition(F.col("file"), F.col("block"))
    found = blocks.mapInArrow(_read(separator, width), "file string, block long, n long, ends array<long>")
    found = written(found, "separators")
    last = F.try_element_at("ends", F.lit(-1))
    sums = found.select(
        "file", "block", "n", F.size("ends").cast("long").alias("docs"),
        F.when(F.size("ends") > 0, F.col("block") * (block // width) + last + 1).alias("after"),
    )
    # Two levels, so that one file of any length is scanned by many tasks.
    sums = sums.withColumn("group", F.floor(F.col("block") / GROUP))
    groups = sums.groupBy("file", "group").agg(F.sum("docs").alias("docs"), F.max("after").alias("after"))
    ahead = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("file", "group", F.coalesce(F.sum("docs").over(ahead), F.lit(0)).alias("docs_ahead"), F.coalesce(F.max("after").over(ahead), F.lit(0)).alias("begun_ahead"))
    ahead = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("docs_before", F.coalesce(F.sum("docs").over(ahead), F.lit(0))).withColumn("begun", F.max("after").over(ahead))
    sums = sums.join(groups, ["file", "group"]).select(
        "file", "block", (F.col("docs_before") + F.col("docs_ahead")).alias("first"), F.coalesce("begun", "begun_ahead").alias("begun")
    )
    met = found.join(sums, ["file", "block"])
    base = F.col("block") * (block // width)
    each = met.select("file", "first", "begun", base.alias("base"), "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("begun")).otherwise(F.col("base") + F.col("ends")[F.col("k") - 1] + 1)
    whole = each.select("file", (F.col("first") + F.col("k")).alias("doc_index"), start.alias("start"), (F.col("base") + F.col("end") - start).alias("n_tokens"))
    # A last document without a separator: what lies after the last one.
    tail = found.groupBy("file").agg(F.max(F.struct("block", "n")).alias("l"), F.sum(F.size("ends").cast("long")).alias("doc_index"), F.max(F.col("block") * (block // width) + last + 1).alias("after"))
    size, begin = F.col("l.block") * (block // width) + F.col("l.n"), F.coalesce("after", F.lit(0))
    tail = tail.where(size > begin).select("file", "doc_index", begin.alias("start"), (size - begin).alias("n_tokens"))
    return whole.unionByName(tail)

"""What the operators share: tables, folds, batches and bounded caches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.session import prepare as prepare_session

#: Rows and bytes that Spark hands to Python at once: texts can be long.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
#: Spark's own defaults, with which the operators' memory was measured; builds set others.
DEFAULTS = {
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.maxConcurrentOutputFileWriters": "0",
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="starwright-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library, its code on the workers, and Arrow batches small enough for long texts."""
    prepare_session(spark)
    ship(spark)
    for key, value in (ARROW | DEFAULTS).items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """The crc32 of an id written as text, modulo ``folds``; null ids are fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null texts are empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.

    ``bytes.split`` cuts at exactly those six characters, and ``bytes.lower``
    changes exactly A-Z.
    """
    return text.lower().split()


class Memo(dict):
    """Remembers a function's results, at most two generations of ``size`` keys."""

    def __init__(self, function: Callable, size: int = 1 << 18):
        super().__init__()
        self.function, self.size, self.old = function, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def runs(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes sum to ``most`` or less, one item at least."""
    start = total = 0
    end = 0
    for end, size in enumerate(sizes, 1):
        if total + size > most and end - 1 > start:
            yield start, end - 1
            start, total = end - 1, 0
        total += size
    if end > start:
        yield start, end


def distinct_name(base: str, taken: Iterable[str]) -> str:
    """``base``, or with underscores until no other column has it."""
    taken = {x.lower() for x in taken}
    while base.lower() in taken:
        base += "_"
    return base


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most so many rows; beyond, Spark shuffles."""
    return F.broadcast(df) if df.count() <= rows else df

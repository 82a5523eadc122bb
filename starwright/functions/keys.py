"""Key expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def md5_key(*parts: Column) -> Column:
    """MD5 of the parts' text, concatenated without separator; null if any is null."""
    return F.md5(F.concat(*[part.cast("string") for part in parts]))


def required(name: str, like: str) -> Column:
    """The column ``name``, failing the job on a null as a primary key would."""
    message = F.lit(f"null in key column {name}")
    return F.coalesce(F.col(name), F.raise_error(message).cast(like)).alias(name)


def require_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``df`` with every key column checked for nulls while it is read."""
    checked = set(keys)
    return df.select(
        *[
            required(f.name, f.dataType.simpleString()) if f.name in checked else F.col(f.name)
            for f in df.schema.fields
        ]
    )

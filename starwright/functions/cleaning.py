"""Clean semi-structured text: Python literals, flag sets, labels, comma lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def python_literal(text: Column) -> Column:
    """Value of a Python literal held as text, as a string.

    ``u'free'`` and ``'free'`` give ``free``; ``True``/``False`` give
    ``true``/``false``; numbers stay as written, exponents included; ``None``,
    empty and anything that is not a literal give null. Escapes in quoted text
    are decoded. Nothing is evaluated.
    """
    trimmed = F.trim(text)
    # Quoted: one quote, after a "u" or not, that the text also ends with.
    bare = F.when(F.substring(trimmed, 1, 1).isin("u", "U"), F.substring(trimmed, 2, 1 << 30)).otherwise(trimmed)
    quote, size = F.substring(bare, 1, 1), F.length(bare)
    quoted = quote.isin("'", '"') & (size >= 2) & F.endswith(bare, quote)
    number = r"^[-+]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]+)?$"
    return (
        F.when(quoted, _unescaped(F.substring(bare, F.lit(2), size - 2)))
        .when(trimmed.isin("True", "False"), F.lower(trimmed))
        .when(trimmed.rlike(number), trimmed)
    )


def _unescaped(inner: Column) -> Column:
    """Decode backslash escapes, as those of a JSON string; unknown ones keep their backslash."""
    free = r"(?<!\\)((?:\\\\)*)"  # as many backslashes before as pair up
    as_json = F.regexp_replace(inner, free + r"\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    as_json = F.regexp_replace(as_json, free + r"\\'", "$1'")
    as_json = F.regexp_replace(as_json, free + r"\\(?![\\\"bfnrtu])", r"$1\\\\")
    as_json = F.regexp_replace(as_json, free + r'"', r'$1\\"')
    in_list = F.concat(F.lit('["'), as_json, F.lit('"]'))
    decoded = F.from_json(in_list, "array<string>", {"allowUnquotedControlChars": "true"})
    return F.when(F.contains(inner, F.lit("\\")), decoded.getItem(0)).otherwise(inner)


def python_flags(text: Column, names: Sequence[str]) -> Column:
    """Text of a Python dict of booleans to a struct with one field per name.

    Missing keys, ``None`` and unreadable text give null fields.
    """
    schema = T.StructType([T.StructField(name, T.BooleanType()) for name in names])
    as_json = F.regexp_replace(text, r"\b[uU](?=['\"])", "")
    for literal, value in (("True", "true"), ("False", "false"), ("None", "null")):
        as_json = F.regexp_replace(as_json, rf"(:\s*){literal}(?=\s*[,}}])", f"$1{value}")
    return F.from_json(as_json, schema, {"allowSingleQuotes": "true"})


def _first_of(branches: Sequence[tuple[Column, str]], default: str | None) -> Column:
    return reduce(
        lambda chosen, branch: F.when(branch[0], F.lit(branch[1])).otherwise(chosen),
        reversed(list(branches)),
        F.lit(default).cast("string"),
    )


def first_true_label(flags: Column, priority: Sequence[str], default: str | None) -> Column:
    """Name of the first set flag, in order of priority."""
    return _first_of([(flags.getField(name), name) for name in priority], default)


def first_contained_label(
    text: Column, labels: Sequence[str | tuple[str, str]], default: str | None = None
) -> Column:
    """First label whose text occurs in ``text`` (case sensitive).

    A label may be a ``(needle, label)`` pair when the two differ.
    """
    pairs = [(item, item) if isinstance(item, str) else item for item in labels]
    return _first_of([(F.contains(text, F.lit(needle)), label) for needle, label in pairs], default)


def null_if(value: Column, sentinel: str) -> Column:
    return F.nullif(value, F.lit(sentinel))


def list_size(text: Column, *, empty_as_zero: bool = False, none_as_zero: bool = False) -> Column:
    """Number of comma-separated items; null stays null.

    By default empty text and the word ``None`` count as one item each, as a
    plain split does; the two options count them as zero.
    """
    size = F.size(F.split(text, ","))
    if empty_as_zero:
        size = F.when(F.length(text) == 0, F.lit(0)).otherwise(size)
    if none_as_zero:
        size = F.when(F.trim(text) == "None", F.lit(0)).otherwise(size)
    return size


def last_item_is(text: Column, value: int) -> Column:
    """Whether the last comma-separated item is this number; never null."""
    last = F.substring_index(text, ",", -1)
    return F.coalesce(last.try_cast("int") == F.lit(value), F.lit(False))


def text_to_boolean(text: Column) -> Column:
    """Boolean-like text to a boolean; anything else becomes null."""
    return text.try_cast("boolean")


def truncate_toward_zero(value: Column) -> Column:
    """Drop the fraction as a bulk load into ``numeric(18,0)`` does (no rounding)."""
    return F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value)).cast("decimal(18,0)")

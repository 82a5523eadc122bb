import hashlib
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starwright.functions import cleaning, keys, timeparts


def values(spark, items, kind, expression):
    """The expression over one column ``x``, in input order."""
    df = spark.createDataFrame(list(enumerate(items)), f"i int, x {kind}")
    return [row.y for row in df.select("i", expression.alias("y")).orderBy("i").collect()]


def x():
    return F.col("x")


def test_python_literal(spark):
    given = ["u'none'", "'free'", 'u"it\'s"', "None", "", None, "True", "False", "3", "-1.5", "junk", "''"]
    expected = ["none", "free", "it's", None, None, None, "true", "false", "3", "-1.5", None, ""]
    assert values(spark, given, "string", cleaning.python_literal(x())) == expected


def test_python_literal_escapes_and_exponents(spark):
    literals = [r"u'caf\u00e9'", r"'it\'s'", r"'a\\b'", r"'say \"x\" \n'", r"'\x41\q'", '\'a"b\\tc\'', "1e5", "-.5E-3", "1e"]
    expected = [eval(x) if "'" in x else x for x in literals[:6]] + ["1e5", "-.5E-3", None]  # noqa: S307
    assert values(spark, literals, "string", cleaning.python_literal(x())) == expected


def test_python_flags_replace_values_only(spark):
    flags = cleaning.python_flags(x(), ["True", "b"])
    (row,) = values(spark, ["{'True': True, u'b': None}"], "string", flags)
    assert (row["True"], row["b"]) == (True, None)


def test_python_flags_and_priority(spark):
    names = ["romantic", "classy", "menu"]
    label = cleaning.first_true_label(cleaning.python_flags(x(), names), names, "N/A")
    given = [
        "{'romantic': False, u'classy': True, 'menu': True}",
        "{u'classy': True, u'romantic': True}",
        "{'menu': True, 'other': None}",
        "{'romantic': False, 'classy': None}",
        "{}",
        "None",
        "",
        None,
        "{'romantic': tru",
    ]
    expected = ["classy", "romantic", "menu", "N/A", "N/A", "N/A", "N/A", "N/A", "N/A"]
    assert values(spark, given, "string", label) == expected


def test_python_flags_missing_key_is_null(spark):
    flags = cleaning.python_flags(x(), ["a", "b"])
    (row,) = values(spark, ["{'b': False}"], "string", flags)
    assert (row.a, row.b) == (None, False)


def test_first_contained_label_is_case_sensitive_and_ordered(spark):
    label = cleaning.first_contained_label(x(), ["American", "Mexican", "Middle Eastern"])
    given = ["Mexican, American", "New Mexican", "american", None, "", "Bars, Middle Eastern"]
    expected = ["American", "Mexican", None, None, None, "Middle Eastern"]
    assert values(spark, given, "string", label) == expected


def test_list_size(spark):
    given = ["a, b, c", "a", "", "None", None]
    assert values(spark, given, "string", cleaning.list_size(x())) == [3, 1, 1, 1, None]
    size = cleaning.list_size(x(), empty_as_zero=True, none_as_zero=True)
    assert values(spark, given, "string", size) == [3, 1, 0, 0, None]


def test_last_item_is(spark):
    given = ["2012,2023", "2023,2012", "2023", "", "None", None, "2012, 2023"]
    expected = [True, False, True, False, False, False, True]
    assert values(spark, given, "string", cleaning.last_item_is(x(), 2023)) == expected


def test_text_to_boolean(spark):
    given = ["True", "False", "u'no'", "None", "", None]
    expected = [True, False, None, None, None, None]
    assert values(spark, given, "string", cleaning.text_to_boolean(x())) == expected


def test_truncate_toward_zero(spark):
    given = [218.93, -80.99, 0.5, -0.5, None]
    got = values(spark, given, "double", cleaning.truncate_toward_zero(x()).cast("long"))
    assert got == [218, -80, 0, 0, None]


def test_epoch(spark):
    given = [1541106106796, -1500, 0, None]
    ms = values(spark, given, "long", timeparts.from_epoch_ms(x()).cast("timestamp_ntz"))
    assert ms[:3] == [
        datetime(2018, 11, 1, 21, 1, 46, 796000),
        datetime(1969, 12, 31, 23, 59, 58, 500000),
        datetime(1970, 1, 1),
    ]
    seconds = values(spark, given, "long", timeparts.from_epoch_ms_as_seconds(x()).cast("timestamp_ntz"))
    # Integer division goes toward zero.
    assert seconds[:2] == [datetime(2018, 11, 1, 21, 1, 46), datetime(1969, 12, 31, 23, 59, 59)]
    assert ms[3] is None and seconds[3] is None


def test_weekday_encodings(spark):
    sunday, monday = datetime(2018, 11, 25, 12), datetime(2018, 11, 26)
    for encoding, expected in {"name": ["Sunday", "Monday"], "zero": [0, 1], "one": [1, 2]}.items():
        got = values(spark, [sunday, monday], "timestamp", timeparts.weekday(x(), encoding))
        assert got == expected
    with pytest.raises(ValueError):
        timeparts.weekday(x(), "two")


def test_iso_week_at_the_turn_of_the_year(spark):
    parts = timeparts.calendar_parts(x(), "zero")
    assert values(spark, [datetime(2018, 12, 31), datetime(2021, 1, 3)], "timestamp", parts["week"]) == [1, 53]


def test_text_dates(spark):
    got = values(spark, ["2019-02-03", "soon", "", None], "string", F.year(timeparts.text_to_timestamp(x())))
    assert got == [2019, None, None, None]


def test_md5_key_is_null_with_a_null_part(spark):
    got = values(spark, [1, None], "int", keys.md5_key(x(), F.lit("a")))
    assert got == [hashlib.md5(b"1a").hexdigest(), None]


def test_required_key_fails_on_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    with pytest.raises(PySparkException, match="null in key column k"):
        keys.require_keys(df, ["k"]).collect()

import datetime

import pytest
from pyspark.sql import functions as F

from firmweave.functions import text as X


def values(spark, fn, inputs):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r.y for r in df.select("i", fn("x").alias("y")).orderBy("i").collect()]


CASES = {
    "core_name": [
        (None, ""), ("Bosch GmbH & Co. KG", "BOSCH"), ("Acme, Inc.", "ACME"), ("Group", ""),
        ("Foo Holding Ltd. Sti", "FOO HOLDING"), ("Texas", "TEXAS"),
        ("Foo - Automotive Division", "FOO"), ("Foo Automotives", "FOOS"), ("Inc Foo", "INC FOO"),
        ("Koza ltd. ŞTİ", "KOZA"), ("a.s", "A.S"), ("foo sa as", "FOO"),
    ],
    "clean_domain": [
        (" HTTPS://www.Foo.com/x?y ", "foo.com"), ("foo.com", "foo.com"),
        ("https://www.linkedin.com/company/x", None), ("https://de.linkedin.com/x", "de.linkedin.com"),
        ("localhost", None), ("foo.c", None), ("http://u@foo.com:8080/x", "u@foo.com:8080"),
        ("", None), (None, None), ("http://www.www.foo.com", "www.foo.com"),
    ],
    "bare_website": [("https://www.Foo.com/x", "foo.com/x"), ("www.foo.com", "foo.com")],
    "canonical_country": [
        (" de ", "GERMANY"), ("Republic of Korea", "SOUTH KOREA"), ("Brazil", "BRAZIL"),
        (None, None), ("Türkiye", "TURKEY"),
    ],
    "lenient_int": [
        ("1999", 1999), ("1999.0", 1999), ("1999.6", 2000), ("1998.5", 1999), (" 1999 ", 1999),
        ("abc", None), ("99999999999", None), ("1999d", None),
    ],
    "lenient_date": [
        ("2024-01-02", datetime.date(2024, 1, 2)), ("2024-01-02T03:04:05", datetime.date(2024, 1, 2)),
        ("2024/01/02", datetime.date(2024, 1, 2)), ("2024", None), ("2024-01-02 junk", None),
        (" 2024-01-02 ", datetime.date(2024, 1, 2)), ("2024-13-02", None),
    ],
    "canonical_name": [("  Foo\t Bar  AG ", "foo bar ag"), (None, None)],
    "token_sort_key": [("koza bilisim", "bilisim koza"), ("  b  a ", "a b"), ("", "")],
    "match_key": [("\t Foo\n", "foo")],
}


@pytest.mark.parametrize("name", CASES)
def test_expression(spark, name):
    inputs, expected = zip(*CASES[name])
    assert values(spark, getattr(X, name), inputs) == list(expected)


def test_stripping_suffixes_until_nothing_changes_equals_one_pattern(spark):
    import itertools
    import re

    parts = ["foo", "gmbh", "&", "co.", "kg", "as", "-", "a.s"]
    names = [" ".join(p) for n in (1, 2, 3, 4) for p in itertools.product(parts, repeat=n)]

    def by_steps(name):
        for tag in X.DIVISION_TAGS:
            name = re.sub(tag, "", name)
        while True:
            shorter = re.sub(rf"\b({X.LEGAL_SUFFIXES})\b\.*$", "", name).strip().rstrip("., /&-")
            if shorter == name:
                return name.upper()
            name = shorter

    assert values(spark, X.core_name, names) == [by_steps(n) for n in names]


def test_missing_and_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("x",)], "x string")
    got = df.select(X.is_missing("x").alias("m"), X.is_blank("x").alias("b")).collect()
    assert [(r.m, r.b) for r in got] == [(True, True), (True, True), (False, True), (False, False)]

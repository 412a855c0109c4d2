"""Text and JSON coercion against Python's own rules."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from quotelake.functions import coerce


def as_float(text):
    try:
        return float(text)
    except ValueError:
        return None


def same(a, b):
    if a is None or b is None:
        return a is b
    return a == b or (math.isnan(a) and math.isnan(b))


EDGE_TEXTS = [
    "", " ", "abc", "invalid", "1_000", " 1.5 ", "1e5", "inf", "-inf", "+Infinity", "INF", "nan", "-NaN", "+nan",
    "1.5d", "1.5f", "0x1p3", "1,000", "true", "True", "5.", ".5", ".", "+.5e-3", "1e", "e5", "--1", "+-1", "1__0",
    "_1", "1_", "1_.5", "1._5", "1_0.2_5e1_0", "\xa01.5　", "\t\n1\r\x0b\x0c", "１２.５", "٣٤", "1 2", "0", "-0.0",
    "1e400", "-1e400", "1e-400", "infinit", "nanx", "1.5\n", "00012", "12345678901234567890", "0.1", "1d", "1L", "½",
]


def test_text_to_double_is_pythons_float(spark):
    rng = random.Random(7)
    made = ["".join(rng.choice("01239._eE+- xnif") for _ in range(rng.randint(1, 8))) for _ in range(3000)]
    texts = EDGE_TEXTS + made + [repr(rng.uniform(-1e12, 1e12)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, got in df.select("t", coerce.text_to_double(F.col("t"))).collect():
        assert same(got, as_float(t)), (t, got, as_float(t))


@pytest.mark.parametrize(
    "text,want",
    [
        ("5", 5), ("5.0", 5), ("5.00", 5), (" 5 ", 5), ("+5", 5), ("-5", -5), ("1_000", 1000), ("1_0.00", 10),
        ("05", 5), ("-0", 0), ("0.0", 0), ("\xa05", 5), ("5\n", 5), ("2147483647", 2147483647),
        ("5.", None), ("1__0", None), ("_1", None), ("1_", None), ("1e3", None), ("", None), ("x", None),
        ("5.5", None), ("5.01", None), (".0", None), ("1_0.0_0", None), ("+ 5", None), ("true", None),
        ("0x5", None), ("１２", None), ("2147483648", None), ("99999999999999999999", None),
    ],
)
def test_text_to_int(spark, text, want):
    assert spark.range(1).select(coerce.text_to_int(F.lit(text))).first()[0] == want


JSON_CASES = [  # JSON text, as double, as int, as required string, Python type, truthy
    ("5", 5.0, 5, None, "int", True),
    ("0", 0.0, 0, None, "int", False),
    ("5.0", 5.0, 5, None, "float", True),
    ("5.5", 5.5, None, None, "float", True),
    ("0.0", 0.0, 0, None, "float", False),
    ("1e20", 1e20, None, None, "float", True),
    ("846000000000", 846e9, None, None, "int", True),
    ("12345678901234567890123", 12345678901234567890123.0, None, None, "int", True),
    ("true", 1.0, 1, None, "bool", True),
    ("false", 0.0, 0, None, "bool", False),
    ("null", None, None, None, "NoneType", False),
    ('"5"', 5.0, 5, "5", "str", True),
    ('"5.0"', 5.0, 5, "5.0", "str", True),
    ('"1.5d"', None, None, "1.5d", "str", True),
    ('"true"', None, None, "true", "str", True),
    ('"false"', None, None, "false", "str", True),
    ('""', None, None, "", "str", False),
    ("[]", None, None, None, "list", False),
    ("[1]", None, None, None, "list", True),
    ("{}", None, None, None, "dict", False),
    ('{"a":1}', None, None, None, "dict", True),
]


def test_json_values(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(JSON_CASES)], "i int, t string")
    v = F.parse_json("t")
    rows = df.select(
        "i",
        coerce.json_to_double(v),
        coerce.json_to_int(v),
        coerce.json_to_string(v),
        coerce.python_type_name(v),
        coerce.json_truthy(v),
    ).collect()
    for i, *got in rows:
        assert tuple(got) == JSON_CASES[i][1:], JSON_CASES[i]
        loaded = json.loads(JSON_CASES[i][0])
        assert got[3] == type(loaded).__name__ and got[4] == bool(loaded)


def test_python_text(spark):
    cases = [('"x"', "x"), ("true", "True"), ("null", "None"), ("7", "7"), ("1.5", "1.5"), ('"' + "é" * 300 + '"', "é" * 200)]
    for text, want in cases:
        assert spark.range(1).select(coerce.python_text(F.parse_json(F.lit(text)))).first()[0] == want

"""Text and JSON values to double, int and string, with Python's acceptance rules.

Spark's own casts accept other spellings (``1.5d``, ``0x1p3``) and refuse some that the
sources rely on (``1_000``), so every cast sits behind a pattern.  All of it is built-in
expressions.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted spellings ---------------------------------------------
BLANKS = (
    " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DIGITS = r"[0-9]+(?:_[0-9]+)*"
PLAIN_DECIMAL = r"^-?[0-9]+(?:\.[0-9]+)?\z"
# group 1 is what Spark's cast takes, which knows no sign before nan
FLOAT_TEXT = (
    r"^(?:[+-](?=(?i:nan)\z))?("
    rf"[+-]?(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?"
    r"|[+-]?(?i:inf|infinity)|(?i:nan))\z"
)
INT_TEXT = rf"^([+-]?{DIGITS})(?:\.0+)?\z"
INT_MIN, INT_MAX = -2147483648, 2147483647
PYTHON_TYPES = {
    "STRING": "str",
    "BIGINT": "int",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "BOOLEAN": "bool",
    "ARRAY": "list",
    "OBJECT": "dict",
    "VOID": "NoneType",
}
# --- end of fixed values ----------------------------------------------------------

# Decimal digits of other scripts count as digits in a float.
_OTHER_DIGITS = "".join(
    chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"
)
_AS_ASCII = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def _accepted(text: Column, pattern: str) -> Column:
    """Group 1 of the pattern without digit separators; NULL when it does not match."""
    return F.translate(F.nullif(F.regexp_extract(strip_blanks(text), pattern, 1), F.lit("")), "_", "")


# The generated code of a cast has to stay small: Java does not compile methods beyond
# 8000 bytes.  So a value passes one cheap pattern or one general one, never a list.  And a
# cast only sees text it takes: a refused text costs an exception, even in try_cast.


def text_to_double(text: Column) -> Column:
    """Lenient: anything that is not a number becomes NULL and never rejects a record."""
    general = _accepted(F.translate(text, _OTHER_DIGITS, _AS_ASCII), FLOAT_TEXT)
    return F.when(text.rlike(PLAIN_DECIMAL), text).otherwise(general).try_cast("double")


def integral(number: Column) -> Column:
    """A double without fraction and in range as int, the rest NULL."""
    in_range = number.between(F.lit(float(INT_MIN)), F.lit(float(INT_MAX)))
    return F.when(in_range & (number == F.floor(number)), number.cast("int"))


def text_to_whole(text: Column) -> Column:
    """The double of an integer text; stage it as a column before :func:`integral`."""
    return _accepted(text, INT_TEXT).try_cast("double")


def text_to_int(text: Column) -> Column:
    """``'5'``, ``' 5 '``, ``'5.0'`` and ``'1_000'`` are integers; NULL when not one."""
    return integral(text_to_whole(text))


# --- JSON values (VARIANT columns) --------------------------------------------------


def json_kind(value: Column) -> Column:
    """Type of a variant: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, ARRAY<..>, OBJECT<..>, VOID."""
    return F.schema_of_variant(value)


def json_to_string(value: Column) -> Column:
    """The text of a JSON string; NULL for a missing value or one of another type."""
    return F.when(json_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def json_number(value: Column) -> Column:
    """Numbers and booleans as double, the rest NULL; take strings by text_to_double."""
    return F.try_variant_get(value, "$", "double")


def json_to_double(value: Column) -> Column:
    """Numbers and booleans as they are, strings by :func:`text_to_double`, the rest NULL."""
    text = json_to_string(value)
    return F.when(text.isNotNull(), text_to_double(text)).otherwise(json_number(value))


def json_to_int(value: Column) -> Column:
    """Integral numbers, booleans and integer texts; NULL for the rest."""
    text = json_to_string(value)
    return F.when(text.isNotNull(), text_to_int(text)).otherwise(integral(json_number(value)))


def json_is_missing(value: Column) -> Column:
    """Absent or an explicit JSON null."""
    return value.isNull() | F.is_variant_null(value)


def json_truthy(value: Column) -> Column:
    """Python truth of a present JSON value: empty, zero and null are false."""
    kind = json_kind(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(value.isNull() | (kind == "VOID"), F.lit(False))
        .when(kind == "STRING", F.length(text) > 0)
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~text.isin("[]", "{}"))
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "double") != 0, F.lit(True)))
    )


def python_type_name(value: Column) -> Column:
    """Name of the Python type a JSON value loads as; NULL for a missing value."""
    # Integers beyond 64 bits are DECIMAL(19..38,0), which the map lacks; 5.0 is DECIMAL(1,0).
    kind = F.regexp_extract(json_kind(value), r"^(DECIMAL\((?:19|[23][0-9]),0\)|[A-Z]+)", 1)
    names = F.create_map(*[F.lit(x) for pair in PYTHON_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, kind), F.when(value.isNotNull(), "int"))


def python_text(value: Column, limit: int = 200) -> Column:
    """Text of a JSON value, cut to ``limit`` characters; objects and lists as JSON."""
    kind = json_kind(value)
    text = (
        F.when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(F.try_variant_get(value, "$", "string")))
        .otherwise(F.try_variant_get(value, "$", "string"))
    )
    return F.substring(text, 1, limit)

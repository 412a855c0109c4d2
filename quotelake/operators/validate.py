"""Typed columns and reject reasons for every record of a source, in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions import coerce
from quotelake.sources.listing import variant_field
from quotelake.specs import FieldSpec, SourceSpec

REASONS = "reject_reasons"
MALFORMED = "malformed"


def _first_present(values: list[Column]) -> Column:
    """The first value that is present, where a JSON null is present and NULL is not."""
    return F.coalesce(*values)


def _lookup(types: dict[str, str], field: FieldSpec) -> tuple[str, Column | None]:
    """How a frame with these columns carries a field: as ``json`` or ``text``, and the column."""
    if "record" in types:
        return "json", _first_present([variant_field("record", n) for n in field.names])
    held = [n for n in field.names if n in types]
    if not held:
        return "text", None
    kind = "json" if types[held[0]] == "variant" else "text"
    return kind, _first_present([F.col(n) for n in held])


def _number(field: FieldSpec, how: str) -> Column:
    """The double behind a numeric field, from its staged raw value and text."""
    from_text = coerce.text_to_double if field.kind == "double" else coerce.text_to_whole
    raw = F.col(f"_{field.name}")
    if how == "text":
        return from_text(raw)
    text = F.col(f"_{field.name}_text")
    return F.when(text.isNull(), coerce.json_number(raw)).otherwise(from_text(text))


def _typed(field: FieldSpec, how: str) -> Column:
    """The typed value from the staged columns of a field."""
    if field.kind == "string":
        raw = F.col(f"_{field.name}")
        return coerce.json_to_string(raw) if how == "json" else raw.cast("string")
    number = F.col(f"_{field.name}_number")
    return number if field.kind == "double" else coerce.integral(number)


def _reasons(field: FieldSpec, missing: str) -> list[Column]:
    value = F.col(field.name)
    found = []
    if field.kind == "string":
        found.append(F.when(value.isNull(), F.lit(f"{field.name}_invalid")))
        if field.max_length:
            length = F.length(value)
            if field.upper:  # upper case can be longer than the original
                length = F.greatest(length, F.length(F.upper(value)))
            found.append(F.when(length > field.max_length, F.lit(f"{field.name}_too_long")))
    elif field.kind == "int":
        found.append(F.when(value.isNull() & ~F.col(missing), F.lit(f"{field.name}_invalid")))
    return found


def validate(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Add the typed fields of ``spec`` and ``reject_reasons``; no row is dropped.

    Scan columns that are not spec fields (``ord``, ``payload``) are kept; unknown source
    fields live on in ``payload`` only.
    """
    types = dict(df.dtypes)
    carried = [c for c in ("ord", "payload", MALFORMED) if c in types]
    found = {f.name: _lookup(types, f) for f in spec.fields}
    nothing = F.lit(None).cast("string")
    # Staged selects: each JSON path is followed once, each text is taken out and cast once.
    raw = df.select(
        *carried, *[(nothing if c is None else c).alias(f"_{n}") for n, (_, c) in found.items()]
    )
    numeric = [f for f in spec.fields if f.kind != "string"]
    texts = [
        coerce.json_to_string(F.col(f"_{f.name}")).alias(f"_{f.name}_text")
        for f in numeric
        if found[f.name][0] == "json"
    ]
    with_texts = raw.select("*", *texts)
    staged = with_texts.select(
        "*", *[_number(f, found[f.name][0]).alias(f"_{f.name}_number") for f in numeric]
    )
    values = [_typed(f, found[f.name][0]).alias(f.name) for f in spec.fields]
    int_fields = [f.name for f in spec.fields if f.kind == "int"]
    missing = {
        n: coerce.json_is_missing(F.col(f"_{n}")) if found[n][0] == "json" else F.col(f"_{n}").isNull()
        for n in int_fields
    }
    checked = staged.select(*carried, *values, *[m.alias(f"_{n}_missing") for n, m in missing.items()])
    reasons = [r for f in spec.fields for r in _reasons(f, f"_{f.name}_missing")]
    if MALFORMED in carried:
        reasons = [
            F.when(F.col(MALFORMED), F.lit(MALFORMED)),
            *[F.when(~F.col(MALFORMED), r) for r in reasons],
        ]
    return checked.withColumn(REASONS, F.array_compact(F.array(*reasons))).drop(
        MALFORMED, *[f"_{n}_missing" for n in int_fields]
    )


def _settled(validated: DataFrame) -> DataFrame:
    """The same rows behind a boundary: a filter above it is not pushed below the staged
    projections, where it would bring in a copy of every parse and cast."""
    return validated.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in validated.columns]))))


def accepted(validated: DataFrame) -> DataFrame:
    return _settled(validated).filter(F.size(REASONS) == 0).drop(REASONS)


def rejected(validated: DataFrame) -> DataFrame:
    return _settled(validated).filter(F.size(REASONS) > 0)


def record_counts(validated: DataFrame) -> DataFrame:
    """One row: ``records_processed`` and ``records_failed``."""
    bad = F.size(REASONS) > 0
    return validated.agg(
        F.count_if(~bad).alias("records_processed"), F.count_if(bad).alias("records_failed")
    )

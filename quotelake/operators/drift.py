"""Schema drift of JSON records against the expected field types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.functions.coerce import python_text, python_type_name

# --- fixed values: confidence per kind of drift, sample length ------------------------
MISSING_CONFIDENCE = 1.0
NEW_CONFIDENCE = 0.8
CHANGED_CONFIDENCE = 0.9
SAMPLE_LENGTH = 200
# --- end of fixed values --------------------------------------------------------------


def detect(
    records: DataFrame,
    expected: dict[str, str],
    source: str,
    detected_at: Column,
    record: str = "record",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per record and drifting field, found in one pass without a shuffle.

    A present null is neither missing nor a type change, and an integer where a float is
    expected is no change.  ``keep`` carries identifying columns of the record along.
    """
    names = F.array(*[F.lit(n) for n in expected]).cast("array<string>")
    types = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair]).cast("map<string,string>")
    absent = F.transform(
        F.array_except(names, F.map_keys("_fields")),
        lambda n: F.struct(n.alias("key"), F.lit(None).cast("variant").alias("value")),
    )
    # A record that is not an object has no fields at all and yields no row.
    fields = (
        records.select(*keep, F.try_variant_get(record, "$", "map<string,variant>").alias("_fields"))
        .select(*keep, F.explode(F.concat(F.map_entries("_fields"), absent)).alias("_field"))
        .select(*keep, F.col("_field.key").alias("field_name"), F.col("_field.value").alias("_value"))
    )
    wanted, actual, value = F.col("expected_type"), F.col("actual_type"), F.col("_value")
    typed = fields.select(
        "*",
        F.try_element_at(types, F.col("field_name")).alias("expected_type"),
        python_type_name(value).alias("actual_type"),
    )
    widened = (wanted == "float") & (actual == "int")
    changed = (actual != wanted) & (actual != "NoneType") & ~widened
    kind = F.when(value.isNull(), "missing_field").when(wanted.isNull(), "new_field").otherwise("type_change")
    return typed.filter(value.isNull() | wanted.isNull() | changed).select(
        *keep,
        F.lit(source).alias("source_name"),
        kind.alias("drift_type"),
        "field_name",
        "expected_type",
        "actual_type",
        F.when(value.isNull(), MISSING_CONFIDENCE)
        .when(wanted.isNull(), NEW_CONFIDENCE)
        .otherwise(CHANGED_CONFIDENCE)
        .alias("confidence_score"),
        python_text(value, SAMPLE_LENGTH).alias("sample_value"),
        detected_at.alias("detected_at"),
        F.lit(False).alias("resolved"),
    )


def summarize(drift: DataFrame) -> DataFrame:
    """Occurrences per source, kind, field and type; the form to keep at scale."""
    return drift.groupBy("source_name", "drift_type", "field_name", "expected_type", "actual_type").agg(
        F.count("*").alias("occurrences"),
        F.max("confidence_score").alias("confidence_score"),
        F.min("sample_value").alias("sample_value"),
    )


def life_cycle(drift: DataFrame, checked: DataFrame) -> DataFrame:
    """One row per source, kind, field and types: when it was first and last found, and when it was gone.

    ``drift`` is the stored log, in either form; ``checked`` has the (source_name, checked_at)
    of every batch that was looked through.  A finding is resolved at the first batch of its source after
    the last that had it; until there is one it is open.  Both are small: findings are summed up
    first, and there is a row per batch.
    """
    kind = ["source_name", "drift_type", "field_name", "expected_type", "actual_type"]
    found = drift.groupBy(*kind).agg(
        F.sum("occurrences").alias("occurrences"),
        F.min("detected_at").alias("first_seen"),
        F.max("detected_at").alias("last_seen"),
    )
    batches = checked.select("source_name", F.col("checked_at").alias("at")).distinct()
    times = found.select("source_name", F.col("last_seen").alias("at")).distinct()
    following = Window.partitionBy("source_name").orderBy("at").rowsBetween(1, 1)
    both = batches.unionByName(times).distinct()
    # a finding's last batch is one of the batches, so the next time is the next batch
    after = both.select(F.col("source_name").alias("_source"), F.col("at").alias("_at"), F.min("at").over(following).alias("resolved_at"))
    state = found.join(after, (F.col("source_name") == F.col("_source")) & (F.col("last_seen") == F.col("_at")), "left")
    return state.select(*kind, "occurrences", "first_seen", "last_seen", "resolved_at", F.col("resolved_at").isNotNull().alias("resolved"))

"""Pages of a total order: by offset at any depth, or after a given row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.session import local_rows, shared_dir

# Pages that end within this many rows come from a top-k; for deeper ones the rows are
# narrowed to a range of about this size first.
TOPK_ROWS = 2_000
SKETCH_SIZE = 8_192
RANK_ERROR = 0.001  # twice what a sketch of this size is off by, nearly always
TEXT_BYTES = 7  # of a text that fit into one positive long
NULL_CODE = -(1 << 63)


@dataclass(frozen=True)
class Key:
    """A column of an order; nulls come first, whichever way it runs."""

    name: str
    descending: bool = False

    @property
    def sort(self) -> Column:
        return F.desc_nulls_first(self.name) if self.descending else F.asc_nulls_first(self.name)


def _literals(df: DataFrame, row: Mapping[str, Any]) -> dict[str, Column | None]:
    """A row's values as typed constants; an integer in a timestamp column is its microseconds."""
    out = {}
    for name, value in row.items():
        kind = df.schema[name].dataType
        if value is None:
            out[name] = None
        elif isinstance(kind, T.TimestampType) and isinstance(value, int):
            out[name] = F.timestamp_micros(F.lit(value))
        elif isinstance(kind, T.TimestampNTZType):  # as text, so that no time zone comes in
            out[name] = F.lit(str(value)).cast(kind)
        else:
            out[name] = F.lit(value).cast(kind)
    return out


def precedes(order: Sequence[Key], row: Mapping[str, Column | None]) -> Column:
    """Whether a row comes before the given one."""
    result = F.lit(False)
    for key in reversed(order):
        column, value = F.col(key.name), row[key.name]
        if value is None:
            result = column.isNull() & result
        else:
            less = column > value if key.descending else column < value
            result = column.isNull() | less | ((column == value) & result)
    return result


def follows(order: Sequence[Key], row: Mapping[str, Column | None]) -> Column:
    """Whether a row comes after the given one."""
    result = F.lit(False)
    for key in reversed(order):
        column, value = F.col(key.name), row[key.name]
        if value is None:
            result = column.isNotNull() | result
        else:
            more = column < value if key.descending else column > value
            result = column.isNotNull() & (more | ((column == value) & result))
    return result


def number_rows(df: DataFrame, order: Sequence[Key], position: str = "position") -> DataFrame:
    """Add the 0-based place of every row in the total ``order``.

    Rows are range-partitioned and sorted, then checkpointed to the shared folder so that
    later passes see the same placement.  Only one count per partition is brought
    together; no task sees more than its range.
    """
    shared_dir(df.sparkSession)
    by = [k.sort for k in order]
    placed = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_part", F.spark_partition_id())
        # the low 33 bits of the id count the rows of a partition from 0
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint()
    )
    sizes = placed.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(position, F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start")
    )


@dataclass(frozen=True)
class _Measure:
    """A column of an order as whole numbers that never fall along it, nulls least.

    Of a text the number has the seven bytes from ``skip`` on, so texts are told apart piece
    by piece.
    """

    key: Key
    kind: T.DataType
    skip: int = 0

    @property
    def is_text(self) -> bool:
        return self.kind == T.StringType()

    @property
    def column(self) -> Column | None:
        """What is compared; None for types without such a number."""
        if self.is_text:
            piece = F.substring(F.encode(self.key.name, "UTF-8"), self.skip + 1, TEXT_BYTES)
            return F.conv(F.hex(F.rpad(piece, F.lit(TEXT_BYTES), F.lit(b"\0"))), 16, 10).cast("bigint")
        known = (T.TimestampType, T.TimestampNTZType, T.DateType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        return F.col(self.key.name) if isinstance(self.kind, known) else None

    @property
    def code(self) -> Column:
        column = self.column
        if isinstance(self.kind, T.TimestampType):
            number = F.unix_micros(column)
        elif isinstance(self.kind, T.TimestampNTZType):  # by its fields, so that no time zone comes in
            minutes = (F.unix_date(column.cast("date")).cast("bigint") * 24 + F.hour(column)) * 60 + F.minute(column)
            number = minutes * 60_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")
        elif isinstance(self.kind, T.DateType):
            number = F.unix_date(column)
        else:
            number = column
        number = number.cast("bigint")
        return F.coalesce(F.bitwise_not(number) if self.key.descending else number, F.lit(NULL_CODE))

    def _value(self, code: int) -> Column:
        number = ~code if self.key.descending else code
        if self.is_text:
            return F.lit(number)
        if isinstance(self.kind, T.TimestampType):
            return F.timestamp_micros(F.lit(number))
        if isinstance(self.kind, T.TimestampNTZType):
            return F.lit(str(datetime(1970, 1, 1) + timedelta(microseconds=number))).cast(self.kind)
        if isinstance(self.kind, T.DateType):
            return F.date_from_unix_date(F.lit(number))
        return F.lit(number).cast(self.kind)

    # both compare the column itself wherever they can, so that the scan sees the range

    def before(self, code: int) -> Column:
        column = self.column
        if code == NULL_CODE:
            return F.lit(False)
        value = self._value(code)
        return column.isNull() | (column > value if self.key.descending else column < value)

    def after(self, code: int) -> Column:
        column = self.column
        if code == NULL_CODE:
            return column.isNotNull()
        value = self._value(code)
        return column.isNotNull() & (column < value if self.key.descending else column > value)


def order_sketch(df: DataFrame, order: Sequence[Key], *groups: str) -> DataFrame:
    """A quantile sketch of the order's first column, for each group; store it beside the table.

    One pass, about 170 KB for each task and group.  Sketches of several groups, or of several
    loads that only add rows, stand for all of their rows together.
    """
    code = _Measure(order[0], df.schema[order[0].name].dataType).code
    return df.groupBy(*groups).agg(F.kll_sketch_agg_bigint(code, F.lit(SKETCH_SIZE)).alias("sketch"))


def _quantiles(spark: SparkSession, sketch: bytes, ranks: list[float]) -> list[int]:
    """Codes at some ranks; worked out on the driver, without a job."""
    one = local_rows(spark, [(sketch,)], T.StructType([T.StructField("sketch", T.BinaryType())]))
    at = F.array(*(F.lit(r) for r in ranks))
    return one.select(F.kll_sketch_get_quantile_bigint("sketch", at)).first()[0]


def _common(least: str | None, most: str | None) -> int:
    """How many bytes all texts between two begin with alike."""
    pairs = zip((least or "").encode(), (most or "").encode())
    return next((i for i, (x, y) in enumerate(pairs) if x != y), min(len((least or "").encode()), len((most or "").encode())))


def _narrow(df: DataFrame, order: Sequence[Key], offset: int, limit: int, sketch: DataFrame | None) -> tuple[DataFrame, int, int]:
    """A range of rows that holds a page, the page's offset in it, and at most how many rows it has.

    A sketch of a column's quantiles, made in one pass, says between which values the page lies;
    one count of the rows before and up to them makes that exact, whatever the sketch's error or
    age.  That leaves about a five-hundredth of the rows.  Where many rows share the value, the
    order's next column is taken, or the next bytes of a text.  Nothing is shuffled but
    sketches and counts, and the columns of the order alone are read.
    """
    rows, size, place, skip = df, None, 0, 0
    while place < len(order):
        measure = _Measure(order[place], df.schema[order[place].name].dataType, skip)
        if measure.column is None:
            break
        fresh = sketch is None
        if fresh:
            name = order[place].name
            ends = (F.min(name), F.max(name)) if measure.is_text else (F.lit(None), F.lit(None))
            made, least, most, nulls, total = rows.agg(
                F.kll_sketch_agg_bigint(measure.code, F.lit(SKETCH_SIZE)), *ends, F.count_if(F.col(name).isNull()), F.count("*")
            ).first()
            size = total
            if min(size, offset + limit) <= TOPK_ROWS or offset >= size:
                break
            alike = _common(least, most)
            if measure.is_text and least != most and not nulls and alike >= skip + TEXT_BYTES:
                skip = alike
                continue
        else:
            made, total = sketch.agg(F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_SIZE)).alias("s")).select("s", F.kll_sketch_get_n_bigint("s")).first()
            sketch = None
            if not total:
                continue
        error = RANK_ERROR
        while True:
            ranks = [min(1.0, max(0.0, r)) for r in (offset / total - error, (offset + limit) / total + error)]
            first, low, high, last = _quantiles(df.sparkSession, bytes(made), [0.0, *ranks, 1.0])
            if fresh and first == last:
                before, upto, size = 0, total, total
            else:
                before, upto, size = rows.agg(F.count_if(measure.before(low)), F.count_if(~measure.after(high)), F.count("*")).first()
            if before <= offset and upto >= min(offset + limit, size):
                break
            if not fresh or ranks == [0.0, 1.0]:  # an outdated sketch, or a page behind the last row
                before, upto = 0, size
                break
            error *= 4
        if offset >= size:
            break
        kept = upto - before
        if kept < size:
            rows = rows.filter(~measure.before(low) & ~measure.after(high))
        offset -= before
        if not fresh and kept == size:
            continue
        if low == high:
            settled = not measure.is_text or (fresh and least == most and nulls in (0, total)) or low == NULL_CODE
            if not settled and kept == size and skip >= alike:
                size = kept
                break  # texts that differ by zero bytes at their end alone
            place, skip = (place + 1, 0) if settled else (place, max(skip + TEXT_BYTES, alike) if kept == size else skip + TEXT_BYTES)
        elif kept > size // 2:
            size = kept
            break
        size = kept
        if min(size, offset + limit) <= TOPK_ROWS:
            break
    return rows, offset, size


def offset_page(df: DataFrame, order: Sequence[Key], offset: int, limit: int, sketch: DataFrame | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of ``df`` in ``order``, sorted.

    ``sketch`` (see :func:`order_sketch`) saves a deep page one pass.  It may be old: the rows
    are counted, and where it misleads a new one is made.
    """
    by = [k.sort for k in order]
    if offset + limit > TOPK_ROWS:
        df, offset, size = _narrow(df, order, offset, limit, sketch)
        if offset >= size:
            return df.limit(0)
        if min(size, offset + limit) > TOPK_ROWS:  # many rows that the sketches cannot part
            position = "_position"
            while position in df.columns:
                position += "_"
            numbered = number_rows(df, order, position)
            return numbered.filter(F.col(position).between(offset, offset + limit - 1)).orderBy(*by).drop(position)
    return df.orderBy(*by).offset(offset).limit(limit)


def page_after(df: DataFrame, order: Sequence[Key], row: Mapping[str, Any], limit: int) -> DataFrame:
    """The first ``limit`` rows after ``row`` (the values of the order's columns), sorted: a top-k at any depth."""
    later = follows(order, _literals(df, {k.name: row[k.name] for k in order}))
    return df.filter(later).orderBy(*(k.sort for k in order)).limit(limit)

"""Array files read in splits: many tasks share one file that holds one array of records.

The text reader cuts files at each closing brace, so a file is split at any place and no
task holds a file.  Whether a brace ends a record depends on all text before it: on the
parity of the quotes and on the depth of the brackets.  Both are prefix sums.  They are taken
within each split for either state it may start in, then over the splits of a file (a row
each), and the two give the state at every brace.  Pieces are then put together by record,
also where a record lies across splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelake.session import sibling
from quotelake.sources.order import with_row_order

PIECE_END = "}"
SPLIT_LAYOUT = "json_array_split"

BLANKS = "[ \\t\\r\\n]*"
OPENING = f"\\A\\uFEFF?{BLANKS}\\["
PLAIN = r'(?s)\\.|[^\\"\[\]{]+'  # escapes, and all that is neither quote nor bracket
STRINGS = r'"[^"]*(?:"|\z)'
STATES = (0, 1)  # a split starts outside or inside a string


def split_session(spark: SparkSession, size: int) -> SparkSession:
    """A session that reads files in splits of ``size`` bytes, and many splits in a task.

    A task for each small split would cost more than its text, and each task of the shuffle
    behind it would fetch a block from every one; so both sides have about as many tasks.
    """
    reader = sibling(spark)  # both are settings of a session
    reader.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    reader.conf.set("spark.sql.files.maxPartitionNum", spark.conf.get("spark.sql.shuffle.partitions"))
    return reader


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _depth(outside: Column) -> Column:
    """What a text without strings adds to the depth of the brackets."""
    return F.length(F.translate(outside, "]", "")) - F.length(F.translate(outside, "[{", ""))


def _piece_numbers(pieces: DataFrame) -> DataFrame:
    """Parity of a piece's quotes, and what it and its closing brace add to the depth from either state.

    What lies outside strings from one state lies inside them from the other.
    """
    marked = pieces.withColumn("_marks", F.regexp_replace("value", PLAIN, ""))
    counted = marked.withColumns(
        {
            "_flip": _count(F.col("_marks"), '"') % 2,
            "_all": _depth(F.col("_marks")),
            "_outer": _depth(F.regexp_replace("_marks", STRINGS, "")),
        }
    )
    return counted.withColumns(
        {"_add0": F.col("_outer") - (1 - F.col("_flip")), "_add1": F.col("_all") - F.col("_outer") - F.col("_flip")}
    ).drop("_marks", "_all", "_outer")


def _running(pieces: DataFrame) -> DataFrame:
    """Depth after each piece relative to its split's start, for either state there."""
    split = Window.partitionBy("_file", "_block").orderBy("_id")
    so_far = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbers = pieces.withColumns(
        {
            "_flips": F.sum("_flip").over(so_far) % 2,
            "_place": F.row_number().over(split),
            "_ends": F.lead("_id").over(split).isNull(),
        }
    )
    inside = (F.col("_flips") + F.col("_flip")) % 2  # before the piece, if the split starts outside
    step = [F.when((inside + s) % 2 == 0, F.col("_add0")).otherwise(F.col("_add1")) for s in STATES]
    return numbers.withColumns({f"_rel{s}": F.sum(step[s]).over(so_far) for s in STATES})


def _split_states(running: DataFrame) -> DataFrame:
    """A row for each split: the state it starts in, and the last end of a record before it.

    Inside an array no depth is below 1, so a record can only end at the lowest depth of a
    split; the last such place is known before the depth at the split's start is.
    """
    inner = ~F.col("_ends")  # the last piece of a file has no brace, so a split's last piece is held apart
    found = []
    for s in STATES:
        rel, outside = F.col(f"_rel{s}"), F.col("_flips") == s
        found += [
            F.max(F.when(F.col("_ends"), rel)).alias(f"_total{s}"),
            F.min(F.when(inner, rel)).alias(f"_low{s}"),
            F.max(F.when(inner & outside, F.struct((-rel).alias("up"), F.col("_place").alias("place")))).alias(f"_cut{s}"),
        ]
    splits = running.groupBy("_file", "_block").agg(
        F.max(F.when(F.col("_ends"), F.col("_flips"))).alias("_odd"),
        F.max("_place").alias("_pieces"),
        F.min_by("_opening", "_place").alias("_opens"),
        *found,
    )
    line = Window.partitionBy("_file").orderBy("_block")
    before, whole = line.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_file")

    def by_state(name: str) -> Column:
        return F.when(F.col("_state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    known = splits.withColumn("_state", F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2)
    known = known.withColumn("_start", F.coalesce(F.sum(by_state("_total")).over(before), F.lit(0)))
    known = known.withColumns(
        {
            "_after": F.col("_start") + by_state("_total"),
            "_outside": (F.col("_state") + F.col("_odd")) % 2 == 0,
            "_first": F.lag("_block").over(line).isNull(),
            "_last": F.lead("_block").over(line).isNull(),
        }
    )
    cut = by_state("_cut")
    place = F.when(~F.col("_last") & F.col("_outside") & (F.col("_after") == 1), F.col("_pieces")).when(
        F.col("_start") - cut["up"] == 1, cut["place"]
    )
    fine = (
        (~F.col("_first") | F.col("_opens"))
        & (F.coalesce(F.col("_start") + by_state("_low"), F.lit(1)) >= 1)
        & F.when(F.col("_last"), F.col("_outside") & (F.col("_after") == -1)).otherwise(F.col("_after") >= 1)
    )
    ended = F.when(place.isNotNull(), F.struct(F.col("_block").alias("block"), place.alias("place")))
    return known.select(
        "_file",
        "_block",
        "_state",
        "_start",
        "_last",
        F.min(fine).over(whole).alias("_array"),
        F.last(ended, ignorenulls=True).over(before).alias("_carried"),
    )


def _texts(pieces: DataFrame) -> DataFrame:
    """Pieces put together up to each end of a record; ``_home`` is the end before, NULL at the file's start.

    A file that is no closed array has a row for each piece.
    """
    running = _running(pieces)
    bare = pieces.withColumn("_opening", F.col("value").rlike(OPENING)).drop("value")  # sorted without its text
    states = _split_states(_running(bare)).withColumnsRenamed({"_file": "_state_file", "_block": "_state_block"})
    joined = running.join(
        states, (F.col("_file") == F.col("_state_file")) & (F.col("_block") == F.col("_state_block")), "left"
    )
    # a split without its state would be text without a place: fail rather than lose it
    state = F.coalesce("_state", F.raise_error(F.lit("a file was split in two ways within one read")).cast("bigint"))
    depth = F.col("_start") + F.when(state == 0, F.col("_rel0")).otherwise(F.col("_rel1"))
    here = F.struct(F.col("_block").alias("block"), F.col("_place").cast("long").alias("place"))
    final = F.col("_ends") & F.col("_last")
    ends = (F.col("_flips") == state) & (depth == 1) & ~final
    earlier = Window.partitionBy("_file", "_block").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = joined.select(
        "_file", "_block", "_id", "value", "_array", "_carried", here.alias("_here"), final.alias("_final"),
        F.when(ends, here).alias("_end"),
    )
    home = F.coalesce(F.last("_end", ignorenulls=True).over(earlier), "_carried")
    own = (
        placed.withColumn("_home", F.when(F.col("_array"), home).otherwise(F.col("_here")))
        .groupBy("_file", "_block", "_home", "_array")  # where the split already is
        .agg(
            F.sort_array(F.collect_list(F.struct("_here", "value"))).alias("_parts"),
            F.max("_final").alias("_final"),
            F.max(F.col("_end").isNotNull() | F.col("_final")).alias("_ended"),
        )
    )
    closed = ~F.col("_array") | (F.coalesce(F.col("_home.block") == F.col("_block"), F.lit(False)) & F.col("_ended"))
    columns = ("_file", "_home", "_array", "_parts", "_final")
    across = own.filter(~closed).groupBy("_file", "_home", "_array").agg(
        F.sort_array(F.flatten(F.collect_list("_parts"))).alias("_parts"), F.max("_final").alias("_final")
    )
    grouped = own.filter(closed).select(*columns).union(across.select(*columns))
    text = F.array_join(F.col("_parts.value"), PIECE_END)
    return grouped.select(
        "_file",
        "_home",
        "_array",
        "_final",
        F.col("_parts")[0]["_here"].alias("_here"),
        F.when(F.col("_final"), text).otherwise(F.concat(text, F.lit(PIECE_END))).alias("_text"),
    )


def split_array_records(pieces: DataFrame) -> DataFrame:
    """One row per array element; ``ord.row`` grows with its place in the file.

    Elements are read as from a whole file, with two differences: an element that is not JSON is
    a malformed row by itself, and a file that is not one closed array is malformed piece by piece,
    so that neither costs more memory than a record (a brace that ends such a file is not kept).
    Files without a piece have no rows.  A run of elements that are no objects stays together up to the next object.
    """
    numbered = pieces.select(
        F.struct("_file_time", "_file_path").alias("_file"),
        F.col("_file_block").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    # text travels once for both uses below, and its numbers are taken before it does
    texts = _texts(_piece_numbers(numbered).repartition("_file", "_block"))
    text, final = F.col("_text"), F.col("_final")
    opening = F.col("_home").isNull()
    follows = f"\\A{BLANKS},"
    nothing = final & text.rlike(f"\\A{BLANKS}\\]{BLANKS}\\z") & ~opening
    dangling = final & text.rlike(f"\\A{BLANKS},{BLANKS}\\]")
    inner = F.when(opening, F.regexp_replace("_text", OPENING, "")).when(
        text.rlike(follows) & ~dangling, F.regexp_replace("_text", follows, "")
    )
    whole = F.concat(F.lit("["), inner, F.when(final, F.lit("")).otherwise(F.lit("]")))
    items = F.try_variant_get(F.try_parse_json(F.when(F.col("_array"), whole)), "$", "array<variant>")
    parsed = texts.filter(~(F.col("_array") & nothing)).withColumn("_items", items)
    rows = parsed.select(
        F.col("_file._file_time").alias("_file_time"),
        F.col("_file._file_path").alias("_file_path"),
        F.col("_here.block").alias("_file_block"),
        F.col("_here.place").alias("_place"),
        F.when(F.col("_items").isNull(), text).alias("_bad"),
        F.posexplode(F.coalesce("_items", F.array(F.lit(None).cast("variant")))),
    )
    ordered = with_row_order(rows, F.shiftleft("_place", 31) + F.col("pos"))
    return ordered.select(
        F.col("col").alias("record"),
        "ord",
        F.coalesce("col", F.col("_bad").cast("variant")).alias("payload"),
        F.col("_bad").isNotNull().alias("malformed"),
    )

"""Notes as text, dense row numbers and batches."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noteloom import contract as C
from noteloom.functions.text import or_empty
from noteloom.session import stored

DATE = "FormattedDate"
PART_BYTES = 64 << 20  # text of a part that holds whole batches
LEAST_BYTES = 1 << 20  # below this a part is not split for the sake of more tasks
PART = "_batch_part"

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, position below


def require_column(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"column '{column}' not found; there are {', '.join(df.columns)}")


def as_text(df: DataFrame, column: str = "Note") -> DataFrame:
    """The notes column as text, null as the empty string."""
    require_column(df, column)
    return df.withColumn(column, or_empty(F.col(column).cast("string")))


def numbered(
    df: DataFrame,
    note: str = "Note",
    name: str = "row_id",
    batch_size: int = C.BATCH_SIZE,
    part: str | None = None,
) -> DataFrame:
    """Rows numbered newest first, then by every other column, copies in any order.

    The rows are written once, with a digest of the note and a number of the copy. These and the
    other columns are numbered without the texts. Every so many numbers a row's order becomes a
    bound; rows find their part between the bounds by halving, so a text moves once, to the part that
    its number lies in. Parts hold whole batches: what groups by the column ``part``, which is kept if
    it is named, and by batch moves no text again.
    """
    rest = [c for c in df.columns if c not in (DATE, note)]
    marks = {
        "_digest": F.sha2(F.col(note), 256),
        "_copy": F.monotonically_increasing_id(),
        "_bytes": F.octet_length(note).cast("long"),
    }
    kept = stored(df.withColumns(marks), "notes")
    rest = [*rest, "_digest", "_copy"]
    first = [F.desc_nulls_last(DATE)] if DATE in df.columns else []
    order = [*first, *[F.asc_nulls_last(c) for c in rest]]
    rows, weight = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("_bytes"), F.lit(0))).first()
    size = _rows_of_part(rows, weight, batch_size, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = max(1, -(-rows // size))
    placed = kept.withColumn("_part", F.lit(0))
    if parts > 1:
        numbers = with_row_id(kept.drop(note, "_bytes"), order, name)
        placed = _in_parts(kept, numbers, name, rest, size, parts)
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    found = placed.repartitionById(parts, F.col("_part")).withColumn(name, F.col("_part").cast("long") * size + rank - 1)
    return found.select(name, *df.columns, *([F.col("_part").alias(part)] if part else []))


def _rows_of_part(rows: int, weight: int, batch_size: int, slices: int) -> int:
    """Rows of a part: whole batches of about ``PART_BYTES`` of text, less where a slice of the
    shuffle would otherwise have none and there is enough for all."""
    parts = max(-(-weight // PART_BYTES), min(slices, -(-weight // LEAST_BYTES)), 1)
    return max(1, -(-rows // (parts * batch_size))) * batch_size


def _in_parts(kept: DataFrame, numbers: DataFrame, name: str, rest: Sequence[str], size: int, parts: int) -> DataFrame:
    """``kept`` with the number of bounds at or before each row, which is that of its part.

    The bounds are one row per part, held once by a task. Each step halves what is left, so a row is
    compared with as many as the number of parts has binary digits.
    """
    dated = DATE in kept.columns
    place = F.struct(*[c for n in rest for c in (F.col(n).isNull().alias(f"{n} null"), F.col(n).alias(n))])
    bound = F.struct(F.col(name).alias("at"), *([F.col(DATE).alias("date")] if dated else []), place.alias("place"))
    every = numbers.where((F.col(name) > 0) & (F.col(name) % size == 0))
    bounds = stored(every.agg(F.sort_array(F.collect_list(bound)).alias("bounds")), "bounds").scalar()
    df = kept.withColumn("_part", F.lit(0))
    for bit in reversed(range((parts - 1).bit_length())):
        ahead = F.col("_part") + (1 << bit)
        one = F.try_element_at(bounds, ahead)
        reached = one["place"] <= place
        if dated:  # newest first, none last
            day, own = one["date"], F.col(DATE)
            earlier = (day > own) | (day.isNotNull() & own.isNull())
            reached = one["at"].isNotNull() & (F.coalesce(earlier, F.lit(False)) | (day.eqNullSafe(own) & reached))
        df = df.withColumn("_part", F.when(reached, ahead).otherwise(F.col("_part")))
    return df


def _placed(df: DataFrame, order: Sequence[Column], unique: bool) -> DataFrame:
    """Rows in sorted range partitions, written once, with partition and position in it."""
    columns = df.columns
    if not unique:
        df = stored(df, "unnumbered").withColumn("_copy", F.monotonically_increasing_id())
        order = [*order, F.asc("_copy")]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*columns, F.monotonically_increasing_id().alias("_place"))
    )
    place = F.col("_place")
    return stored(placed, "row-ids").select(
        *columns,
        F.shiftright(place, _LOCAL_BITS).alias("_partition"),
        place.bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_position"),
    )


def with_row_id(
    df: DataFrame, order: Sequence[Column], name: str = "row_id", unique: bool = True
) -> DataFrame:
    """Dense 0-based numbers in the given order, without a single-task sort.

    A row's number is its position in its range partition plus the sizes of the partitions
    before it. The offsets are one row per partition.

    Rows that tie in ``order`` share a partition. Where copies of a row are possible, say
    ``unique=False``: the input is written first and its position in those files tells
    copies apart, so that many copies spread over many partitions.
    """
    placed = _placed(df, order, unique)
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_partition")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_partition").select(
        (F.col("_offset") + F.col("_position")).alias(name), *df.columns
    )


def with_batches(numbered: DataFrame, batch_size: int = C.BATCH_SIZE, row_id: str = "row_id") -> DataFrame:
    """Consecutive batches of ``batch_size`` rows; the last may be shorter."""
    return numbered.withColumns(
        {
            "batch_id": F.expr(f"`{row_id}` div {int(batch_size)}"),
            "pos_in_batch": (F.col(row_id) % batch_size).cast("int"),
        }
    )


def merge_by_row(left: DataFrame, right: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Side by side on the row number; the shorter side is padded with nulls."""
    twice = (set(left.columns) & set(right.columns)) - {row_id}
    if twice:
        raise ValueError(f"columns on both sides: {', '.join(sorted(twice))}")
    return left.join(right, row_id, "full")

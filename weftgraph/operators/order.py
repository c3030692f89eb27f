"""Numbers and caps in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .iterate import cut

# What a result may hold at most.
MOST_ROWS, MOST_BYTES = 10_000, 5_000_000


def numbered(rows: DataFrame, order: list[Column | str], name: str = "issue") -> DataFrame:
    """Rows with their number from 1 in an order that ends in a unique column.

    The order is dealt out by ranges; each range counts for itself, and the sums of those
    before (one row for each range) make the numbers whole.
    """
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()))
    # the id holds the range in its upper bits, the place in the range in its lower 33
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__part")).count()
    before = sizes.select("__part", F.coalesce(F.sum("count").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    out = placed.withColumn("__part", part).join(F.broadcast(before), "__part")  # one row for each range
    return out.withColumn(name, (F.col("__before") + place + 1).cast("long")).drop("__id", "__part", "__before")


def weight(rows: DataFrame) -> Column:
    """Bytes of a row: those of its values as text."""
    return sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in rows.columns), F.lit(0))


def capped(rows: DataFrame, order: list[Column | str], most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The first rows in order, at most ``most_rows`` and ``most_bytes``, with column truncated: whether there are others.

    Only ``most_rows`` + 1 rows meet in one task.
    """
    first = rows.withColumn("__bytes", weight(rows)).orderBy(*order).limit(most_rows + 1)
    line = W.orderBy(*order)
    seen = first.withColumns({"__n": F.row_number().over(line), "__sum": F.sum("__bytes").over(line.rowsBetween(W.unboundedPreceding, 0))})
    fits = (F.col("__n") <= most_rows) & (F.col("__sum") <= most_bytes)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return seen.withColumn("truncated", F.max(~fits).over(whole)).where(fits).drop("__bytes", "__n", "__sum")

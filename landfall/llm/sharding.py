"""Shards cut from a Hilbert curve over metadata, for pruning by several columns at once.

Every dimension is quantised by quantiles of the whole table (texts by whole texts), the levels give a
Hilbert index, rows are range-sorted by it, and equal runs of the order are the
shards. Built-in functions only. The one shuffle is the range sort; a cell with a
third of all rows is split by the tie-breakers, as ranges are cut by the full order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.base import col, free_name, saved, shared_dir
from landfall.llm.hilbert import curve_column


_TEXTS = ("string", "binary", "varchar", "char")


def as_number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("date", "timestamp", "timestamp_ntz", "boolean"):
        return col(df, name).cast("timestamp").cast("double") if kind != "boolean" else col(df, name).cast("int").cast("double")
    return col(df, name).cast("double")


def text_bounds(df: DataFrame, name: str, levels: int) -> list:
    """The whole texts at the quantiles of a column, by the exact number of rows up to each distinct text.

    The texts are counted, range-sorted and numbered through the places of their partitions; ``levels`` of
    them at most come back.
    """
    counts = df.filter(col(df, name).isNotNull()).groupBy(col(df, name).alias("v")).agg(F.count("*").alias("n"))
    ordered = saved(counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("place", F.monotonically_increasing_id()), "texts")
    part = F.shiftright(F.col("place"), 33).alias("part")
    sizes = ordered.groupBy(part).agg(F.sum("n").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"), F.sum("rows").over(whole).alias("total"))
    up_to = F.sum("n").over(Window.partitionBy("part").orderBy("place"))  # the distinct texts of one range
    placed = ordered.select("v", "n", "place", part).join(F.broadcast(starts), "part").withColumn("up_to", F.col("start") + up_to)
    at = [F.min(F.when(F.col("up_to") * levels > F.col("total") * k, F.col("v"))).alias(f"q{k}") for k in range(1, levels)]
    return [bytes(q) if isinstance(q, bytearray) else q for q in placed.agg(*at).first() if q is not None]


def level(value: Column, bounds: list) -> Column:
    """How many bounds are at or below the value; null is level 0."""
    if not bounds:
        return F.lit(0)
    return F.coalesce(sum((F.when(value >= F.lit(b), 1).otherwise(0) for b in bounds[1:]), F.when(value >= F.lit(bounds[0]), 1).otherwise(0)), F.lit(0))


def curve_order(df: DataFrame, dimensions: list[str], bits: int = 4) -> Column:
    """The Hilbert index of each row, by the quantiles of each dimension over the whole table."""
    texts = [d for d in dimensions if df.schema[d].dataType.typeName() in _TEXTS]
    numbers = [d for d in dimensions if d not in texts]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    bounds = {d: text_bounds(df, d, 1 << bits) for d in texts}
    if numbers:
        stats = df.agg(*[F.percentile_approx(as_number(df, d), shares, 1000).alias(f"q{i}") for i, d in enumerate(numbers)]).first()
        bounds |= {d: stats[i] or [] for i, d in enumerate(numbers)}
    levels = [level(col(df, d) if d in texts else as_number(df, d), sorted(set(bounds[d]))) for d in dimensions]
    return curve_column(levels, bits)


def shard(df: DataFrame, dimensions: list[str], ties: list[str], shards: int, bits: int = 4) -> DataFrame:
    """``df`` with ``curve``, ``shard`` and ``slot``: runs of the curve order whose row counts differ by one at most.

    Order: Hilbert index, then ``ties`` (nulls first). Rows equal in all of them are
    interchangeable and lie side by side. Null and unknown values are level 0. An empty
    table gives no rows. Columns of those names that ``df`` has already keep their name;
    the new ones get a trailing underscore.
    """
    curve, number, slot = (free_name(df, n) for n in ("curve", "shard", "slot"))
    place = free_name(df, "_place")
    keys = [F.col(curve).asc(), *[col(df, t).asc_nulls_first() for t in ties]]
    ordered = df.withColumn(curve, curve_order(df, dimensions, bits))
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The position of a row: range partition in the upper bits, row of the sorted partition in the lower 33.
    ordered = saved(ordered.withColumn(place, F.monotonically_increasing_id()), "curve")
    part, rows, start, total, at = (free_name(ordered, n) for n in ("_part", "_rows", "_start", "_total", "_rank"))
    of_row = F.shiftright(F.col(place), 33)
    sizes = ordered.groupBy(of_row.alias(part)).agg(F.count("*").alias(rows))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    whole = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(part, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(start), F.sum(rows).over(whole).alias(total))
    rank = F.col(start) + F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    short = F.floor(F.col(total) / shards).cast("long")
    long_rows = (F.col(total) % shards) * (short + 1)  # rows in the shards that hold one more
    in_long = F.col(at) < long_rows
    over = F.col(at) - long_rows
    return (
        ordered.join(F.broadcast(starts), of_row == F.col(part))
        .withColumn(at, rank)
        .withColumn(number, F.when(in_long, F.col(at) / (short + 1)).otherwise(F.col(total) % shards + over / F.greatest(short, F.lit(1))).cast("int"))
        .withColumn(slot, F.when(in_long, F.col(at) % (short + 1)).otherwise(over % F.greatest(short, F.lit(1))))
        .drop(place, part, start, total, at)
    )


def write_shards(df: DataFrame, dimensions: list[str], ties: list[str], shards: int, path: str | None = None) -> str:
    """Writes whole rows as Parquet, one folder a shard, each file a stretch of the curve with narrow column ranges."""
    path = path or shared_dir(df.sparkSession, "shards")
    placed = shard(df, dimensions, ties, shards)
    placed.write.partitionBy(placed.columns[-2]).parquet(path)
    return path

"""Ordered work that stays parallel when one key, or the whole table, is a single group.

A window over one huge group is one task. Here such a group is range-sorted into splits
of bounded size, the splits are written once so their numbering is stable, and what
crosses a split border is one small row per (split, key).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql import Window as W

from tidemark.session import materialize, rows_per_task

#: Sampled rows a key at the threshold is expected to show.
_SAMPLE_ROWS = 2_000
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)
_FIXED = (T.FloatType, T.DoubleType, T.BooleanType, T.DateType, T.DecimalType)
#: More than the 2**64 bigint tiebreaks and NULL, so that neighbouring microseconds never overlap.
_TIES = 2**64 + 2
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def order_key(df: DataFrame, ts: str, tiebreak: Sequence[str] = ()) -> Column:
    """One sortable value for (ts, tiebreak).

    With one integer tiebreak both fit a decimal, which aggregation buffers can update in
    place, so ``max_by`` runs as a hash aggregate; a struct would force a sort first. A NULL
    tiebreak comes before every number. Integer times are ordered as a struct.
    """
    if not tiebreak:
        return F.col(ts)
    timed = isinstance(df.schema[ts].dataType, (*_TIMES, T.DateType))
    if timed and len(tiebreak) == 1 and isinstance(df.schema[tiebreak[0]].dataType, _INTEGRAL):
        micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
        tie = F.coalesce(F.col(tiebreak[0]).cast("decimal(20,0)"), F.lit(Decimal(-(2**63) - 1)))
        return micros * F.lit(Decimal(_TIES)) + tie
    return F.struct(ts, *tiebreak)


def pick_last(df: DataFrame, by: Sequence[str], order: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``order`` per key, without the columns in ``drop``.

    A partial aggregate: each map task sends at most one row per key, so a hot key does not
    reach the shuffle. If the other columns have fixed widths and the order is one integer or
    time, they are picked one by one, all by the same order value, and aggregate by hash.
    """
    rest = [c for c in df.columns if c not in by and c not in drop]
    out = [c for c in df.columns if c not in drop]
    if not rest:
        return df.select(*out).distinct()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fixed_widths = all(isinstance(kinds[c], (*_INTEGRAL, *_TIMES, *_FIXED)) for c in rest)
    if fixed_widths and len(order) == 1 and isinstance(kinds[order[0]], (*_INTEGRAL, *_TIMES)):
        value = F.col(order[0])
        value = F.unix_micros(value.cast("timestamp")) if isinstance(kinds[order[0]], _TIMES) else value.cast("bigint")
        rows = df.withColumn("_order", F.coalesce(value, F.lit(-(2**63)).cast("bigint")))
        return rows.groupBy(*by).agg(*[F.max_by(c, "_order").alias(c) for c in rest]).select(*out)
    picked = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(c) if c in by else F.col(f"_row.{c}").alias(c) for c in out])


@dataclass(frozen=True)
class HotKeys:
    """Keys with too many rows for one task, written aside; Spark's size checks pick the joins on them."""

    keys: list[str]
    values: DataFrame
    split_count: int
    split_rows: int

    def splits(self, df: DataFrame, order: Sequence[str], unique: bool) -> DataFrame:
        """The hot keys' rows of ``df``, range-sorted into numbered splits."""
        return ordered_splits(self.only(df), [*self.keys, *order], unique, self.split_count, self.split_rows)

    def only(self, df: DataFrame) -> DataFrame:
        return df.join(self.values, self.keys, "left_semi").select(*df.columns)

    def others(self, df: DataFrame) -> DataFrame:
        return df.join(self.values, self.keys, "left_anti").select(*df.columns)


def hot_keys(rows: DataFrame, keys: Sequence[str], limit_rows: int) -> HotKeys | None:
    """The keys with more than ``limit_rows`` rows, or None.

    Only the key columns are read, and only a sample is counted: the outcome chooses the
    plan for a key, never its result.
    """
    fraction = min(1.0, _SAMPLE_ROWS / limit_rows)
    named = rows.select(*keys).where(_all_set(keys))
    if fraction < 1.0:
        named = named.sample(fraction, seed=11)
    counted = named.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit_rows * fraction)
    # nearly always there is none, and then nothing is written
    seen = counted.agg(F.sum("_n")).first()[0]
    if not seen:
        return None
    found = materialize(counted, "hot-keys")
    return HotKeys(list(keys), found.drop("_n"), 2 * math.ceil(seen / fraction / limit_rows), limit_rows)


def ordered_splits(df: DataFrame, order: Sequence[str], unique: bool, splits: int | None = None, most: int | None = None) -> DataFrame:
    """Rows range-sorted on ``order`` with stable ``_split`` and ``_pos`` (0-based in the split).

    Spark draws the ranges from a sample of limited size, so with very many of them some are
    far too large: those of more than twice ``most`` rows are cut again until none is left.

    The row numbers come from the sorted partitions themselves: one shuffle, no window. Ties
    cannot be told apart by range; if ``order`` is not ``unique`` the rows are first written
    with a number, so that even a table of copies is split.
    """
    if not unique:
        numbered = df.withColumn("_row", F.monotonically_increasing_id())
        return ordered_splits(materialize(numbered, "told-apart"), [*order, "_row"], True, splits, most).drop("_row")
    placed = _ranged(df, order, splits)
    return _subdivided(placed, order, most) if most else placed


def _ranged(df: DataFrame, order: Sequence[str], splits: int | None) -> DataFrame:
    ranged = df.repartitionByRange(splits, *order) if splits else df.repartitionByRange(*order)
    numbered = ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    stable = materialize(numbered, "ordered")
    return stable.withColumns(
        {
            "_split": F.shiftright("_id", _LOCAL_BITS),
            "_pos": F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
        }
    ).drop("_id")


def _subdivided(placed: DataFrame, order: Sequence[str], most: int, before: int | None = None) -> DataFrame:
    """``placed`` with its overfull splits cut again, and all splits numbered anew in order.

    Rows that tie in ``order`` cannot be cut; the work ends when the largest split stays as it is.
    """
    sizes = placed.groupBy("_split").agg(F.count("*").alias("_n")).where(F.col("_n") > 2 * most)
    total, largest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if not total or largest == before:
        return placed
    overfull = materialize(sizes, "overfull")
    large = placed.join(overfull.select("_split"), "_split", "left_semi")
    inner = large.select(*[c for c in placed.columns if c not in ("_split", "_pos")], F.col("_split").alias("_outer"))
    cut = _ranged(inner, ["_outer", *order], 2 * math.ceil(total / most))
    # a new range may hold the end of one split and the start of the next
    firsts = cut.groupBy("_outer", "_split").agg(F.min("_pos").alias("_first"))
    rest = placed.join(overfull.select("_split"), "_split", "left_anti")
    named = firsts.select("_outer", "_split").union(rest.select(F.col("_split"), F.lit(-1).cast("bigint")).distinct())
    # one row per split
    numbers = materialize(named.toDF("_outer", "_inner").withColumn("_new", F.row_number().over(W.orderBy("_outer", "_inner")).cast("bigint") - 1), "splits")
    whole = rest.withColumn("_outer", F.col("_split")).withColumn("_inner", F.lit(-1).cast("bigint"))
    parts = cut.join(firsts, ["_outer", "_split"]).withColumn("_pos", F.col("_pos") - F.col("_first")).withColumn("_inner", F.col("_split"))
    columns = [c for c in placed.columns if c != "_split"]
    both = whole.select(*columns, "_outer", "_inner").unionByName(parts.select(*columns, "_outer", "_inner"))
    renamed = materialize(both.join(numbers, ["_outer", "_inner"]).select(*columns, F.col("_new").alias("_split")), "subdivided")
    return _subdivided(renamed.select(*placed.columns), order, most, largest)


def with_row_index(
    df: DataFrame, order: Sequence[str], name: str = "row_index", unique: bool = True, rows_per_split: int | None = None
) -> DataFrame:
    """Add the 0-based position of every row in the order ``order``.

    Pass ``unique=False`` if the order has large ties; they are then numbered in any order. The
    rows are counted first, so that a split never holds many more than one task should; the one
    unpartitioned window runs over a row per split.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = rows_per_task(spark, rows_per_split)
    placed = ordered_splits(df, order, unique, max(least, math.ceil(df.count() / most)), most)
    sizes = placed.groupBy("_split").agg(F.count("*").alias("_n"))
    before = W.orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return placed.join(offsets, "_split").select(
        *df.columns, (F.col("_offset") + F.col("_pos")).alias(name)
    )


def row_number_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_number", rows_per_key: int | None = None
) -> DataFrame:
    """1-based row number per key; a hot key's numbers follow from its rows' places in the splits.

    Keys are compared as one struct, in which NULLs are equal: rows without a key are a key too.
    """
    rows = df.withColumn("_key", F.struct(*keys))

    def number(part):
        w = W.partitionBy("_key").orderBy(*order)
        return part.select(*df.columns, F.row_number().over(w).cast("bigint").alias(name))

    hot = hot_keys(rows, ["_key"], rows_per_task(df.sparkSession, rows_per_key))
    if hot is None:
        return number(rows)
    placed = hot.splits(rows, order, unique=False)
    parts = placed.groupBy("_split", "_key").agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy("_key").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    # one row per (split, hot key)
    shifts = parts.select(
        "_split", "_key", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    numbered = placed.join(shifts, ["_split", "_key"]).select(
        *df.columns, (F.col("_pos") + F.col("_shift")).alias(name)
    )
    return number(hot.others(rows)).unionByName(numbered)


def carry_forward(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carried: dict[str, Column],
    keep: str,
    hot: HotKeys | None,
    unique: bool,
) -> DataFrame:
    """Per key in ``order``, add the last non-null of each ``carried`` value up to the row.

    Only rows where the boolean column ``keep`` holds are returned. All values share one
    window and one shuffle. Hot keys go through ordered splits: each split carries within
    itself, and the value entering a split comes from the ends of the splits before it.
    ``unique`` says that ``order`` has no ties within a key.
    """

    def carry(part, by, sort):
        w = W.partitionBy(*by).orderBy(*sort).rowsBetween(W.unboundedPreceding, W.currentRow)
        added = [F.last(value, ignorenulls=True).over(w).alias(n) for n, value in carried.items()]
        return part.select("*", *added).where(keep)

    if hot is None:
        return carry(rows, keys, order)
    placed = hot.splits(rows, order, unique)
    ends = placed.groupBy("_split", *keys).agg(
        *[F.max_by(v, F.when(v.isNotNull(), F.col("_pos"))).alias(n) for n, v in carried.items()]
    )
    before = W.partitionBy(*keys).orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    # one row per (split, hot key)
    entering = ends.select(
        "_split", *keys, *[F.last(n, ignorenulls=True).over(before).alias(f"_in_{n}") for n in carried]
    )
    hot_carried = (
        carry(placed, ["_split", *keys], ["_pos"])
        .join(entering, ["_split", *keys], "left")
        .select(*rows.columns, *[F.coalesce(n, f"_in_{n}").alias(n) for n in carried])
    )
    return carry(hot.others(rows), keys, order).unionByName(hot_carried)


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

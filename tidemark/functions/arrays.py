"""Nested values: order-book levels and array-shaped JSON results."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from tidemark.operators.combine import first_levels, union_all
from tidemark.operators.ordering import hot_keys
from tidemark.session import rows_per_task

PRICE_DIGITS = 4
#: Up to so many hot keys are told from the others by a join; beyond, the rows of every key are cut.
KEYS_APART = 10_000
#: Rows whose levels one task gathers into books, if those of all keys were cut.
ROWS_PER_TASK = 500_000


def order_book(
    df: DataFrame, by: Sequence[str], price: str, size: str, max_levels: int = 5, rows_per_key: int | None = None
) -> DataFrame:
    """One row per key: ``bids`` and ``asks`` as [[price, size], ...], at most ``max_levels`` each.

    Bids run from the highest price down, asks from the lowest up. One window numbers both: a
    row's ask level is its bid level counted from the other end. The rows of hot keys are cut
    to the best levels of either side before they are shuffled; if a great many keys are hot,
    those of all keys are, and no join sorts the table once more for each side.
    """
    rows = df.select(*by, F.col(price).alias("_price"), F.col(size).cast("double").alias("_size"))
    # as one struct, in which NULLs are equal: rows without a key are a key too
    keyed = rows.withColumn("_key", F.struct(*by))
    hot = hot_keys(keyed, ["_key"], rows_per_task(df.sparkSession, rows_per_key))
    if hot is None:
        levels = _levels_of_whole_keys(rows, by, max_levels)
    elif hot.split_count > 2 * KEYS_APART:  # two splits or more for each hot key
        levels = _levels_cut_early(rows, by, max_levels, math.ceil(2 * rows.count() / ROWS_PER_TASK))
    else:
        few, many = hot.others(keyed).drop("_key"), hot.only(keyed).drop("_key")
        levels = _levels_of_whole_keys(few, by, max_levels).unionByName(_levels_cut_early(many, by, max_levels), allowMissingColumns=True)
    return levels.groupBy(*by).agg(_side("_bid", max_levels).alias("bids"), _side("_ask", max_levels).alias("asks"))


def _levels_of_whole_keys(rows: DataFrame, by: Sequence[str], max_levels: int) -> DataFrame:
    key = W.partitionBy(*by)
    levels = rows.withColumns({"_bid": F.row_number().over(key.orderBy(F.desc("_price"), F.desc("_size"))), "_n": F.count("*").over(key)})
    levels = levels.withColumn("_ask", F.col("_n") - F.col("_bid") + 1).drop("_n")
    return levels.where(F.least("_bid", "_ask") <= max_levels)


def _levels_cut_early(rows: DataFrame, by: Sequence[str], max_levels: int, tasks: int | None = None) -> DataFrame:
    """The levels of either side; dealt out to ``tasks``, each side is sorted by tasks of its own."""
    sides = []
    for name, order in (("_bid", [F.desc("_price"), F.desc("_size")]), ("_ask", [F.asc("_price"), F.asc("_size")])):
        best = first_levels(rows, by, order, max_levels).withColumnRenamed("level", name)
        sides.append(best.repartition(tasks, *by) if tasks else best)
    return union_all(*sides)


def _side(level: str, max_levels: int) -> Column:
    # prices are rounded after sorting
    pair = F.struct(level, F.round("_price", PRICE_DIGITS).alias("p"), F.col("_size").alias("s"))
    kept = F.collect_list(F.when(F.col(level) <= max_levels, pair))
    return F.transform(F.array_sort(kept), lambda x: F.array(x["p"], x["s"]))


def explode_levels(df: DataFrame, by: Sequence[str], levels: str) -> DataFrame:
    """One row per level: the 1-based ``level``, ``price`` and ``size``."""
    opened = df.select(*by, F.posexplode(levels).alias("_pos", "_pair"))
    return opened.select(
        *by,
        (F.col("_pos") + 1).alias("level"),
        F.element_at("_pair", 1).alias("price"),
        F.element_at("_pair", 2).alias("size"),
    )


def flatten_dataset(response: Column, field: str = "dataset") -> Column:
    """Values of a JSON result ``{"dataset": [[..], ..]}`` as one flat array of text."""
    parsed = F.from_json(response, f"`{field}` array<array<string>>")
    return F.flatten(parsed[field])

"""As-of joins: each left row gets the latest right row at or before its own time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordering import carry_forward, hot_keys
from tidemark.session import rows_per_task


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    ts: str,
    columns: Mapping[str, str],
    right_ts: str | None = None,
    tiebreak: Sequence[str] = (),
    rows_per_key: int | None = None,
) -> DataFrame:
    """Left columns plus ``columns`` (right name -> output name) of the matching right row.

    Times are compared inclusively. Unmatched left rows keep NULLs. Among right rows with the
    same time the highest ``tiebreak`` wins. Both sides are stacked and carried forward in
    one pass over a single shuffle; no pairs are ever formed. Left rows without a key match
    nothing and skip that pass. ``left`` is read three times (keys, rows with and without a
    key): write it aside first if it is more than a scan.
    """
    right_ts = right_ts or ts
    taken = F.struct(*[F.col(src).alias(out) for src, out in columns.items()])
    taken_type = right.select(taken.alias("x")).schema["x"].dataType
    tie = F.struct(*tiebreak) if tiebreak else F.lit(0)
    tie_type = right.select(tie.alias("x")).schema["x"].dataType
    keys = [f"_key{i}" for i in range(len(by))]
    key_columns = [F.col(c).alias(k) for c, k in zip(by, keys)]

    drivers = left.where(_none_null(by)).select(
        *key_columns,
        F.col(ts).alias("_ts"),
        F.lit(1).alias("_side"),
        F.lit(None).cast(tie_type).alias("_tie"),
        F.struct("*").alias("_left"),
        F.lit(None).cast(taken_type).alias("_right"),
    )
    matches = right.where(_none_null([*by, right_ts])).select(
        *key_columns,
        F.col(right_ts).alias("_ts"),
        F.lit(0).alias("_side"),
        tie.alias("_tie"),
        F.lit(None).cast(left.schema).alias("_left"),
        taken.alias("_right"),
    )
    stacked = drivers.unionByName(matches).withColumn("_keep", F.col("_side") == 1)
    hot = hot_keys(stacked, keys, rows_per_task(left.sparkSession, rows_per_key))
    order = ["_ts", "_side", "_tie"]
    carried = carry_forward(stacked, keys, order, {"_match": F.col("_right")}, "_keep", hot, unique=False)
    keyless = left.where(~_none_null(by)).withColumn("_match", F.lit(None).cast(taken_type))
    return carried.select("_left.*", "_match").union(keyless).select(*left.columns, "_match.*")


def asof_wide(
    long: DataFrame,
    by: str,
    sensor: str,
    sensors: Sequence,
    ts: str,
    value: str,
    tiebreak: Sequence[str] = (),
    full_ts: bool = False,
    rows_per_key: int | None = None,
) -> DataFrame:
    """As-of join every sensor onto the rows of the first one, from one long table.

    Gives ``ts, by, value_1 .. value_n`` (and ``timestamp_2 ..`` with ``full_ts``). The number
    of sensors adds neither joins nor shuffles: each is a column carried over the readings in
    one window. ``tiebreak`` should end on a unique column. Keys with more than
    ``rows_per_key`` rows (by default the session's rows per task) are split.
    """
    rows = long.where(F.col(sensor).isin(list(sensors)) & _none_null([by, ts])).select(
        by, ts, sensor, value, *[t for t in tiebreak if t not in (by, ts, sensor, value)]
    )
    rows = rows.withColumn("_side", (F.col(sensor) == sensors[0]).cast("bigint"))
    reading = F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))
    carried = {f"_s{i}": F.when(F.col(sensor) == s, reading) for i, s in enumerate(sensors[1:], start=2)}
    rows = rows.withColumn("_keep", F.col("_side") == 1).withColumn("value_1", F.col(value))
    hot = hot_keys(rows, [by], rows_per_task(rows.sparkSession, rows_per_key))
    joined = carry_forward(rows, [by], [ts, "_side", *tiebreak], carried, "_keep", hot, unique=bool(tiebreak))
    out = [F.col(ts), F.col(by), F.col("value_1")]
    for i in range(2, len(sensors) + 1):
        if full_ts:
            out.append(F.col(f"_s{i}.t").alias(f"timestamp_{i}"))
        out.append(F.col(f"_s{i}.v").alias(f"value_{i}"))
    return joined.select(*out)


def _none_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])

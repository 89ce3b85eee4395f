"""Rows to line-protocol text; the inverse of the reader in ``sources``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.times import nanos

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def to_lines(
    df: DataFrame,
    table: str,
    symbols: Sequence[str],
    fields: Sequence[str],
    ts: str | None = None,
    name: str = "value",
) -> DataFrame:
    """One text column. NULL symbols and fields are left out; without ``ts`` the receiver's clock counts.

    ``ts`` is a timestamp, or a bigint of epoch nanoseconds.
    """
    head = F.concat(
        F.lit(_escape_literal(table)),
        *[_entry(",", s, escape(F.col(s).cast("string"))) for s in symbols],
    )
    kinds = {f: df.schema[f].dataType for f in fields}
    entries = [F.concat(F.lit(_escape_literal(f) + "="), encode_field(F.col(f), kinds[f])) for f in fields]
    parts = [head, F.nullif(F.concat_ws(",", *entries), F.lit(""))]
    if ts is not None:
        stamp = F.col(ts) if isinstance(df.schema[ts].dataType, T.LongType) else nanos(ts)
        parts.append(stamp.cast("string"))
    return df.select(F.concat_ws(" ", *parts).alias(name))


def write_lines(df: DataFrame, path: str, *args, **kwargs) -> None:
    to_lines(df, *args, **kwargs).write.mode("append").text(path)


def encode_field(value: Column, data_type: T.DataType) -> Column:
    """Typed text of a field value, NULL for NULL."""
    if isinstance(data_type, _INTEGRAL):
        return F.concat(value.cast("string"), F.lit("i"))
    if isinstance(data_type, T.BooleanType):
        return F.when(value, "t").when(~value, "f")
    if isinstance(data_type, _TIMES):
        return F.concat(F.unix_micros(value.cast("timestamp")).cast("string"), F.lit("t"))
    if isinstance(data_type, T.StringType):
        quoted = F.replace(F.regexp_replace(value, r'(["\\])', r"\\$1"), F.lit("\n"), F.lit("\\n"))
        return F.concat(F.lit('"'), quoted, F.lit('"'))
    return value.cast("string")


def escape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, r"([,= \\])", r"\\$1"), F.lit("\n"), F.lit("\\n"))


def _escape_literal(text: str) -> str:
    return "".join("\\" + c if c in ",= \\" else c for c in text)


def _entry(separator: str, name: str, value: Column) -> Column:
    present = F.concat(F.lit(f"{separator}{_escape_literal(name)}="), value)
    return F.coalesce(F.when(value != "", present), F.lit(""))

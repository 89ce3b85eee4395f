r"""Line-protocol text to columns: ``table,symbol=a,… field=1,… time_ns``.

A backslash escapes the next character in names and symbols, quoted strings may hold commas
and spaces, and ``\n`` stands for a line break, so any text survives a round trip.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.times import from_nanos

# possessive repeats: one pass over the text, and no recursion on long values
_HEAD = r"^(?:[^ \\]++|\\.)++"
_TABLE = r"^(?:[^,\\]++|\\.)++"
_SYMBOL = r"((?:[^=,\\]++|\\.)++)=((?:[^,\\]++|\\.)*+)"
_FIELD = r'((?:[^=,\\]++|\\.)++)=("(?:[^"\\]++|\\.)*+"|[^,"]++)'
_FIELDS = rf"^{_FIELD}(?:,{_FIELD})*+$"
_TIME = r"^-?\d+$"
_TRUE = ["t", "T", "true", "True", "TRUE"]


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parsed lines of text files, as :func:`parse_lines` gives them."""
    return parse_lines(spark.read.text(paths).where(F.trim("value") != ""), "value")


def parse_lines(df: DataFrame, line: str) -> DataFrame:
    """(table, symbols, fields, ts_ns, malformed): the maps hold raw text, ``ts_ns`` may be NULL."""
    parts = df.select(F.rtrim(line).alias("_line"), F.regexp_extract(line, _HEAD, 0).alias("_head"))
    parts = parts.withColumns(
        {
            "_table": F.regexp_extract("_head", _TABLE, 0),
            "_rest": F.expr("substring(_line, length(_head) + 2)"),
            "_last": F.substring_index("_line", " ", -1),
        }
    )
    # the time is the last word; inside a quoted string a last word would end in the quote
    timed = F.col("_last").rlike(_TIME) & (F.col("_rest") != "")
    fields = F.when(timed, F.expr("substring(_rest, 1, length(_rest) - length(_last) - 1)")).otherwise(F.col("_rest"))
    parts = parts.select(
        "_head",
        "_table",
        F.expr("substring(_head, length(_table) + 2)").alias("_symbols"),
        fields.alias("_fields"),
        F.when(timed, F.col("_last")).try_cast("bigint").alias("ts_ns"),
    )
    return parts.select(
        unescape(F.col("_table")).alias("table"),
        _pairs("_symbols", _SYMBOL).alias("symbols"),
        _pairs("_fields", _FIELD).alias("fields"),
        "ts_ns",
        ((F.col("_head") == "") | ((F.col("_fields") != "") & ~_well_formed("_fields"))).alias("_broken"),
    ).select(
        "table",
        F.coalesce("symbols", F.create_map().cast(_PAIRS)).alias("symbols"),
        F.coalesce("fields", F.create_map().cast(_PAIRS)).alias("fields"),
        "ts_ns",
        (F.col("_broken") | F.col("symbols").isNull() | F.col("fields").isNull()).alias("malformed"),
    )


def count_bad(parsed: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """One row: lines, malformed lines, and well-formed lines of which a listed field cannot be read as its type."""
    unreadable = F.lit(False)
    for name, kind in fields.items():
        raw = F.col("fields")[name]
        unreadable = unreadable | (raw.isNotNull() & typed_field(raw, kind).isNull())
    return parsed.agg(
        F.count("*").alias("lines"),
        F.count_if("malformed").alias("malformed"),
        F.count_if(~F.col("malformed") & unreadable).alias("unreadable"),
    )


def select_table(
    parsed: DataFrame, table: str, symbols: Sequence[str], fields: Mapping[str, str], ts: str = "timestamp"
) -> DataFrame:
    """One table's well-formed rows as typed columns; a missing or unreadable value is NULL.

    :func:`count_bad` tells how many lines and values that leaves out.
    """
    rows = parsed.where(~F.col("malformed") & (F.col("table") == table))
    return rows.select(
        *[unescape(F.col("symbols")[s]).alias(s) for s in symbols],
        *[typed_field(F.col("fields")[f], t).alias(f) for f, t in fields.items()],
        from_nanos(F.col("ts_ns")).alias(ts),
        "ts_ns",
    )


def typed_field(raw: Column, data_type: str) -> Column:
    if data_type == "string":
        return unescape(F.substring(raw, F.lit(2), F.length(raw) - 2))
    if data_type == "boolean":
        return F.when(raw.isNotNull(), raw.isin(_TRUE))
    if data_type == "timestamp":
        return F.timestamp_micros(F.rtrim(raw, F.lit("t")).try_cast("bigint"))
    return F.rtrim(raw, F.lit("iu")).try_cast(data_type)


def unescape(text: Column) -> Column:
    r"""Undo escapes in one left-to-right reading: ``\\`` pairs first, then the rest between them."""
    between = F.transform(
        F.split(text, r"\\\\"),
        lambda s: F.regexp_replace(F.replace(s, F.lit("\\n"), F.lit("\n")), r"\\(.)", "$1"),
    )
    return F.when(F.contains(text, F.lit("\\")), F.array_join(between, "\\")).otherwise(text)


#: Without quotes and escapes an entry is name=value, and separators separate.
_SPECIAL = r'[\\"]'
_PLAIN_FIELDS = r"^[^=,]+=[^=,]+(?:,[^=,]+=[^=,]+)*+$"
_PAIRS = "map<string,string>"


def _well_formed(part: str) -> Column:
    text = F.col(part)
    return F.when(text.rlike(_SPECIAL), text.rlike(_FIELDS)).otherwise(text.rlike(_PLAIN_FIELDS))


def _pairs(part: str, pattern: str) -> Column:
    """name=value pairs as a map, NULL if a name repeats; text without quotes or escapes takes the short way."""
    text = F.col(part)
    names = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), unescape)
    pairs = F.map_from_arrays(names, F.regexp_extract_all(text, F.lit(pattern), F.lit(2)))
    short = F.transform(F.split(text, ","), lambda e: F.substring_index(e, "=", 1))
    return (
        F.when(text == "", F.create_map().cast(_PAIRS))
        .when(text.rlike(_SPECIAL), F.when(F.size(F.array_distinct(names)) == F.size(names), pairs))
        .otherwise(F.when(F.size(F.array_distinct(short)) == F.size(short), F.str_to_map(text, F.lit(","), F.lit("="))))
    )

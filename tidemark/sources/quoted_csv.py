"""CSV with line breaks inside quotes, read in parallel, and rejected rows kept apart.

A line break ends a record unless an odd number of quotes precedes it in the file; doubled
quotes never change that. So each split of a file is read as plain lines: the parity of its
quotes turns either state it may be entered in, inside or outside quotes, into the state it is
left in. A running sum over one row per split combines the splits, after which every split
knows how it is entered and cuts its lines into records on its own. Only the pieces of records
that cross splits, two per split at most, are put together afterwards. A file is as parallel as
it has splits, however its records lie.

Records are then parsed one by one. A record that has another number of columns, a value that
does not fit its column, or a quote left open is rejected with its file, first line and reason,
in the same pass; good and rejected records add up to all records.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql import Window as W

from tidemark.session import materialize

_SPLIT_CONF = "spark.sql.files.maxPartitionBytes"
_CORRUPT = "_corrupt"
_SPLIT = ["file", "block"]


@contextlib.contextmanager
def _split_bytes(spark: SparkSession, most: int | None) -> Iterator[None]:
    before = spark.conf.get(_SPLIT_CONF)
    if most:
        spark.conf.set(_SPLIT_CONF, str(most))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT_CONF, before)


def csv_records(spark: SparkSession, paths: str | Sequence[str], split_bytes: int | None = None) -> DataFrame:
    """(file, record, line, text, open) of every record of some files: its number and first line, counted from 0 and 1.

    Blank lines outside quotes are no records. ``open`` says that the last record's quote has
    no end. ``split_bytes`` sets the size of splits instead of the session's. The lines are
    read once and written aside with their places.
    """
    with _split_bytes(spark, split_bytes):
        lines = spark.read.option("lineSep", "\n").text(paths).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
            F.col("value").alias("text"),
            (F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))).alias("quotes"),
        )
        lines = materialize(lines, "csv-lines")

    # one row per split: what enters it follows from the splits before
    splits = lines.groupBy(*_SPLIT).agg(F.sum("quotes").alias("quotes"), F.count("*").alias("lines"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    entered = splits.select(
        *_SPLIT,
        F.coalesce(F.sum("quotes").over(before) % 2, F.lit(0)).alias("entered"),
        F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("lines_before"),
    )
    place = W.partitionBy(*_SPLIT).orderBy("id")
    so_far = place.rowsBetween(W.unboundedPreceding, -1)
    placed = lines.join(entered, _SPLIT).withColumns(
        {
            "inside": (F.col("entered") + F.coalesce(F.sum("quotes").over(so_far), F.lit(0))) % 2 == 1,
            "line": F.col("lines_before") + F.row_number().over(place),
        }
    )
    # records of a split are counted from 1; 0 is the rest of one that began before
    begun = F.sum(F.when(F.col("inside"), 0).otherwise(1)).over(place.rowsBetween(W.unboundedPreceding, W.currentRow))
    pieces = _joined(placed.withColumn("piece", begun), [*_SPLIT, "piece"], "line")
    pieces = materialize(pieces, "csv-pieces")

    counts = pieces.groupBy(*_SPLIT).agg(F.max("piece").alias("last"))
    numbered = pieces.join(
        counts.select(*_SPLIT, "last", F.coalesce(F.sum("last").over(before), F.lit(0)).alias("records_before")), _SPLIT
    ).withColumn("record", F.col("records_before") + F.col("piece") - 1)
    crossing = (F.col("piece") == 0) | ((F.col("piece") == F.col("last")) & (F.col("quotes") % 2 == 1))
    columns = ["file", "record", "line", "text", "quotes"]
    whole = numbered.where(~crossing).select(*columns)
    put_together = _joined(numbered.where(crossing).select(*columns), ["file", "record"], "line").select(*columns)
    every = whole.unionByName(put_together).withColumn("open", F.col("quotes") % 2 == 1).drop("quotes")
    return every.where(F.col("open") | (F.regexp_replace("text", r"\r$", "") != ""))


def _joined(pieces: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Texts of a group joined by line breaks in order, with the first line and all quotes."""
    listed = F.array_sort(F.collect_list(F.struct(order, "text")))
    grouped = pieces.groupBy(*by).agg(listed.alias("listed"), F.sum("quotes").alias("quotes"))
    text = F.array_join(F.transform("listed", lambda x: x["text"]), "\n")
    return grouped.select(*by, F.get("listed", F.lit(0))[order].alias("line"), text.alias("text"), "quotes")


@dataclass(frozen=True)
class CsvLoad:
    """What a load made of some files: typed rows, and (file, line, reason, text) of the rejected records."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def load_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, header: bool = True, split_bytes: int | None = None, **options
) -> CsvLoad:
    """Typed rows of CSV files, columns by position, and the records that do not fit.

    ``options`` are those of Spark's CSV parser. Files may be wider than the schema if their
    header is, of which the first columns are taken. An empty value is NULL, two quotes are an
    empty text. Records are parsed once; ``counts`` says how many there are and how many are good and rejected.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = csv_records(spark, paths, split_bytes)
    names = [f"_c{i}" for i in range(len(schema.fields))]
    width = len(names)
    if header:
        first = records.where("record = 0").select("text").limit(1).collect()
        width = max(width, len(_header(spark, first[0]["text"], options))) if first else width
        records = records.where("record > 0")
    every = [f"_c{i}" for i in range(width)]
    text_schema = ", ".join(f"{n} string" for n in [*every, _CORRUPT])
    parsed = F.from_csv(F.regexp_replace("text", r"\r$", ""), text_schema, _parsing(options))
    told = records.select("file", "line", "text", "open", parsed.alias("p")).select("file", "line", "text", "open", "p.*")
    typed = {f.name: _typed(F.col(n), f.dataType, options) for n, f in zip(names, schema.fields)}
    reason = F.when(F.col("open"), "quote left open").when(F.col(_CORRUPT).isNotNull(), f"not {width} columns")
    for name, f in zip(names, schema.fields):
        given = F.col(name) if isinstance(f.dataType, T.StringType) else F.nullif(F.col(name), F.lit(""))
        misfit = given.isNotNull() & typed[f.name].isNull()
        reason = reason.when(misfit, f"{f.name} is no {f.dataType.simpleString()}")
    values = F.struct(*[v.alias(n) for n, v in typed.items()]).alias("row")
    judged = materialize(told.select("file", "line", reason.alias("reason"), F.when(reason.isNotNull(), F.col("text")).alias("text"), values), "csv-judged")
    seen = judged.agg(F.count("*").alias("records"), F.count("reason").alias("rejected")).first()
    counts = {"records": seen["records"], "good": seen["records"] - seen["rejected"], "rejected": seen["rejected"]}
    return CsvLoad(judged.where("reason IS NULL").select("row.*"), judged.where("reason IS NOT NULL").select("file", "line", "reason", "text"), counts)


def _parsing(options: dict) -> dict:
    # a value no file holds: empty values are NULL all the same, and quoted empty texts are not
    return {"escape": '"', "nullValue": "\u0001", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "maxCharsPerColumn": "-1", **{k: str(v) for k, v in options.items()}}


def _header(spark: SparkSession, text: str, options: dict) -> list[str]:
    """Values of a header line."""
    wide = text.count(str(options.get("sep", ","))) + 1
    schema = ", ".join(f"c{i} string" for i in range(wide))
    row = spark.range(1).select(F.from_csv(F.lit(text.rstrip("\r")), schema, {k: v for k, v in _parsing(options).items() if k != "columnNameOfCorruptRecord"}).alias("p")).first()["p"]
    return [v for v in row if v is not None]


def _typed(value: Column, kind: T.DataType, options: dict) -> Column:
    if not isinstance(kind, T.StringType):
        value = F.nullif(value, F.lit(""))
    pattern = options.get("timestampFormat") if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else None
    if pattern:
        return F.try_to_timestamp(value, F.lit(pattern)).try_cast(kind)
    return value.try_cast(kind)

"""URL filters by a temporal list join.

A list is a set of dated entries: from a time on, a host pattern is ``block`` or ``allow``, or
it is off the list (any other action). An entry holds until the pattern's next entry, so the
entries of a pattern become validity intervals. A capture is judged by the entries active when
it was fetched: of its host and all parent domains the longest pattern with an active ``block``
or ``allow`` decides.

The as-of join is one ordered pass: intervals and the times asked about are stacked, sorted by
time within each pattern, and the last interval is carried forward to each asked time. No
pairs of intervals and times are formed. A pattern with very many rows is split by time over
tasks, as in the other ordered operators. Only distinct (host, time) pairs are asked about, and
only patterns that the list has; decisions then join the captures on (host, time), where
adaptive execution splits a hot pair.

Defined cases: a date counts as its midnight; a null or unreadable url, a null time and a host
without active entries are not blocked and have null pattern, action and listed_on; of several
entries of a pattern at one time the one with the largest `seq` holds, then the alphabetically
last action; entries with a null pattern or time never apply; hosts ignore case, user, port and
a final dot; repeated captures are judged each; empty tables give no rows or no blocks; other
columns of the captures are returned as they are, unless called like those added, which are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import carry_forward, hot_keys, row_number_by
from tidemark.session import materialize, rows_per_task


def host_of(url: str) -> Column:
    """The lower-case host of a url, null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    host = F.regexp_replace(host, r"\.$", "")
    return F.when(host != "", host)


def validity_intervals(entries: DataFrame, rows_per_pattern: int | None = None) -> DataFrame:
    """pattern, action, valid_from, valid_to (exclusive, null while it still holds) of a list (pattern, action, listed_on, seq).

    The entries of a pattern are numbered by time, those of a pattern with more than
    `rows_per_pattern` rows in splits, and each is joined with the next number's.
    """
    named = entries.where("pattern IS NOT NULL AND listed_on IS NOT NULL").select(
        F.lower("pattern").alias("pattern"), F.col("listed_on").alias("valid_from"), F.struct("seq", "action").alias("entry")
    )
    by_time = materialize(named.groupBy("pattern", "valid_from").agg(F.max("entry").alias("entry")), "entries")
    numbered = materialize(row_number_by(by_time, ["pattern"], ["valid_from"], "_n", rows_per_pattern), "numbered-entries")
    following = numbered.select("pattern", (F.col("_n") - 1).alias("_n"), F.col("valid_from").alias("valid_to"))
    return numbered.join(following, ["pattern", "_n"], "left").select("pattern", F.col("entry.action").alias("action"), "valid_from", "valid_to")


def _active(asked: DataFrame, entries: DataFrame, rows_per_pattern: int | None) -> DataFrame:
    """`asked` (pattern, _at) with the `block` or `allow` interval that holds at that time."""
    valid = materialize(validity_intervals(entries, rows_per_pattern), "intervals")
    interval = F.struct("action", "valid_from", "valid_to")
    kind = valid.select(interval.alias("x")).schema["x"].dataType
    # an interval comes before the times asked about at its start
    stacked = valid.select("pattern", F.col("valid_from").cast("timestamp_ntz").alias("_at"), F.lit(0).alias("_asks"), interval.alias("_interval")).union(
        asked.join(valid.select("pattern").distinct(), "pattern", "left_semi").select("pattern", "_at", F.lit(1), F.lit(None).cast(kind))
    )
    stacked = stacked.withColumn("_keep", F.col("_asks") == 1)
    hot = hot_keys(stacked, ["pattern"], rows_per_task(asked.sparkSession, rows_per_pattern))
    carried = carry_forward(stacked, ["pattern"], ["_at", "_asks"], {"_last": F.col("_interval")}, "_keep", hot, unique=True)
    ends = F.col("_last.valid_to").cast("timestamp_ntz")
    holds = (ends.isNull() | (F.col("_at") < ends)) & F.col("_last.action").isin("block", "allow")
    return carried.where(holds).select("pattern", "_at", "_last.action", "_last.valid_from")


def judge(captures: DataFrame, entries: DataFrame, rows_per_pattern: int | None = None) -> DataFrame:
    """`captures` (url, fetched_at) with pattern, action, listed_on and blocked added.

    A pattern with more rows than `rows_per_pattern`, or the session's setting, is split over tasks.
    """
    added = ("pattern", "action", "listed_on", "blocked")
    kept = [c for c in captures.columns if c not in added]
    asked = captures.select(*[F.col(f"`{c}`") for c in kept], host_of("url").alias("_host"), F.col("fetched_at").cast("timestamp_ntz").alias("_at"))
    times = asked.where("_host IS NOT NULL AND _at IS NOT NULL").select("_host", "_at").distinct()

    labels = F.split("_host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    suffixes = materialize(times.select("_host", "_at", F.explode(parents).alias("pattern")), "suffixes")
    active = _active(suffixes.select("pattern", "_at").distinct(), entries, rows_per_pattern)
    longest = F.max(F.struct(F.length("pattern").alias("n"), "pattern", "action", "valid_from")).alias("best")
    decided = suffixes.join(active, ["pattern", "_at"]).groupBy("_host", "_at").agg(longest)
    judged = asked.join(decided, ["_host", "_at"], "left")
    return judged.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("best.pattern").alias("pattern"),
        F.col("best.action").alias("action"),
        F.col("best.valid_from").alias("listed_on"),
        F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"),
    )


def drop_blocked(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """The captures that no active entry blocks, with their own columns."""
    judged = judge(captures.withColumn("_whole", F.struct(*[F.col(f"`{c}`") for c in captures.columns])).select("_whole", "url", "fetched_at"), entries)
    return judged.where("NOT blocked").select("_whole.*")

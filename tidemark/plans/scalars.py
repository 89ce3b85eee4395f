"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import geo, keys, text, times
from tidemark.functions.arrays import explode_levels, order_book
from tidemark.operators.maintenance import falsy_to_null, retained
from tidemark.plans.registry import plan, table

_CELLS = """
    SELECT c_custkey, CAST(floor((c_custkey % 360 - 180 + 180.0::DOUBLE) / 360.0::DOUBLE * 262144) AS BIGINT) AS x,
           CAST(floor((c_acctbal / 10000 * 80 + 90.0::DOUBLE) / 180.0::DOUBLE * 131072) AS BIGINT) AS y
    FROM customer
"""
GEOHASH_SQL = f"""
    SELECT c_custkey, array_to_string(list_transform(range(0, 7), lambda c:
             substr('{geo.ALPHABET}', CAST((h >> (5 * (6 - c))) & 31 AS INTEGER) + 1, 1)), '') AS g7c
    FROM (SELECT c_custkey, CAST(list_sum(list_transform(range(0, 18), lambda i: ((x >> i) & 1) << (2 * i)))
                 + list_sum(list_transform(range(0, 17), lambda i: ((y >> i) & 1) << (2 * i + 1))) AS BIGINT) AS h
          FROM ({_CELLS}))
"""


def customer_places(customer):
    """Customers with a made-up position: the table has none."""
    return customer.select(
        "c_custkey",
        (F.col("c_custkey") % 360 - 180).cast("double").alias("lon"),
        (F.col("c_acctbal") / 10000 * 80).alias("lat"),
    )


@plan(GEOHASH_SQL)
def geohash7(spark, sf_dir):
    places = customer_places(table(spark, sf_dir, "customer"))
    return places.select("c_custkey", geo.make_geohash(F.col("lon"), F.col("lat")).alias("g7c"))


@plan("""
    SELECT o_orderkey, o_orderdate AS day, date_trunc('year', o_orderdate)::TIMESTAMP AS year FROM orders
""")
def parse_timestamp(spark, sf_dir):
    written = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), F.date_format("o_orderdate", "yyyy").alias("y")
    )
    return written.select(
        "o_orderkey",
        F.to_timestamp("d", "yyyy-MM-dd").cast("timestamp_ntz").alias("day"),
        F.to_timestamp("y", "yyyy").cast("timestamp_ntz").alias("year"),
    )


@plan("SELECT event_id, date_trunc('second', ts)::TIMESTAMP + INTERVAL 6 HOUR AS instant FROM events")
def parse_clock_12h(spark, sf_dir):
    written = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", times.CLOCK_12H).alias("t"))
    return written.select(
        "event_id", times.parse_clock_12h(F.col("t"), "-06:00").cast("timestamp_ntz").alias("instant")
    )


@plan("""
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN epoch_us(date_trunc('second', ts)) * 1000
                     ELSE epoch_us(ts) * 1000 END AS ts_ns
    FROM events
""")
def parse_iso(spark, sf_dir):
    kind = F.col("event_type")
    written = (
        F.when(kind == "error", "no time")
        .when(kind == "click", F.date_format("ts", times.ISO_SECONDS))
        .otherwise(F.date_format("ts", times.ISO_FRACTION))
    )
    return table(spark, sf_dir, "events").select("event_id", times.nanos(times.parse_iso(written)).alias("ts_ns"))


@plan("""
    SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch_us(ts) AS us, epoch_us(ts) * 1000 AS ns,
           date_trunc('milliseconds', ts)::TIMESTAMP AS from_ms, ts AS from_ns
    FROM events
""")
def epoch_units(spark, sf_dir):
    us = times.micros("ts")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        ms.alias("ms"),
        us.alias("us"),
        times.nanos("ts").alias("ns"),
        times.from_millis(ms).cast("timestamp_ntz").alias("from_ms"),
        times.from_nanos(times.nanos("ts")).cast("timestamp_ntz").alias("from_ns"),
    )


@plan("SELECT event_id, ts, value, epoch_us(ts) AS ln_timestamp FROM events")
def update_epoch_micros(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "value", times.micros("ts").alias("ln_timestamp"))


@plan("""
    SELECT event_id, date_trunc('day', ts - INTERVAL 5000 DAY)::TIMESTAMP AS floored,
           date_trunc('hour', ts)::TIMESTAMP AS hour, ts + INTERVAL 90 MINUTE AS later
    FROM events
""")
def date_floor_add(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.timestamp_floor("d", times.date_add("d", -5000, ts)).cast("timestamp_ntz").alias("floored"),
        times.timestamp_floor("h", ts).cast("timestamp_ntz").alias("hour"),
        times.date_add("m", 90, ts).cast("timestamp_ntz").alias("later"),
    )


@plan("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE ts END AS ts FROM events
""")
def default_ts(spark, sf_dir):
    sent = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"))
    arrival = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return sent.select("event_id", times.default_ts("ts", arrival).alias("ts"))


@plan("""
    SELECT o_orderkey, concat(chr(CAST(65 + (i // 65536 // 676) % 26 AS INTEGER)), chr(CAST(65 + (i // 65536 // 26) % 26 AS INTEGER)),
                  chr(CAST(65 + (i // 65536) % 26 AS INTEGER)), printf('%04X', i % 65536)) AS vehicle_id
    FROM (SELECT o_orderkey, o_orderkey * 40961 AS i FROM orders)
""")
def vehicle_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", keys.vehicle_id(F.col("o_orderkey") * 40961).alias("vehicle_id")
    )


@plan("""
    SELECT event_id, CAST(trunc(value * 1.5::DOUBLE) AS BIGINT) AS visits, CAST(trunc(-value) AS INTEGER) AS below,
           CAST(user_id AS DOUBLE) AS user_double, CAST(event_id AS VARCHAR) AS id_text
    FROM events
""")
def cast_truncate(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value") * 1.5).cast("bigint").alias("visits"),
        (-F.col("value")).cast("int").alias("below"),
        F.col("user_id").cast("double").alias("user_double"),
        F.col("event_id").cast("string").alias("id_text"),
    )


@plan("SELECT event_id, concat(event_type, ' CST') AS zoned, concat('DROP ', event_type, ' <= ', user_id) AS statement FROM events")
def concat_strings(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat("event_type", F.lit(" CST")).alias("zoned"),
        F.concat(F.lit("DROP "), "event_type", F.lit(" <= "), "user_id").alias("statement"),
    )


@plan("""
    SELECT doc_id, replace(CASE WHEN length(text) > 75 THEN concat(substr(text, 1, 75), '..') ELSE text END, '"', '&quot;') AS summary
    FROM documents
""")
def summary_truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.summarize("text").alias("summary"))


@plan("SELECT doc_id, regexp_replace(text, '[^\\p{L}\\p{N}_]', '_', 'g') AS symbol FROM documents")
def sanitize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.sanitize("text").alias("symbol"))


@plan("""
    SELECT event_id, concat('ev,kind=', event_type, CASE WHEN event_type = 'error' THEN '' ELSE concat(',user=', user_id) END,
                  ' value=', value, ' ', epoch_us(ts)) AS line
    FROM events
""")
def strip_empty_fields(spark, sf_dir):
    user = F.when(F.col("event_type") == "error", "").otherwise(F.col("user_id").cast("string"))
    line = F.concat(
        F.lit("ev,kind="), "event_type", F.lit(",user="), user, F.lit(",none= value="), "value", F.lit(",note= "), times.micros("ts")
    )
    return table(spark, sf_dir, "events").select("event_id", text.strip_empty_fields(line).alias("line"))


_LEVELS = """
    SELECT l_orderkey, side, CAST(level AS INTEGER) AS level, round(l_extendedprice, 4) AS price, l_quantity AS size
    FROM (SELECT *, 'bid' AS side, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_quantity DESC) AS level FROM lineitem
          UNION ALL
          SELECT *, 'ask' AS side, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_quantity) AS level FROM lineitem)
    WHERE level <= 5
"""


@plan(_LEVELS, name="price_levels")
def order_book_levels(spark, sf_dir, rows_per_key=None):
    book = order_book(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_extendedprice", "l_quantity", rows_per_key=rows_per_key)
    sides = F.inline(F.array(*[F.struct(F.lit(s[:-1]).alias("side"), F.col(s).alias("levels")) for s in ("bids", "asks")]))
    return explode_levels(book.select("l_orderkey", sides), ["l_orderkey", "side"], "levels")


@plan(_LEVELS)
def price_levels_split(spark, sf_dir):
    """Order books with every key of more than two orders cut before the shuffle."""
    return order_book_levels(spark, sf_dir, rows_per_key=2)


@plan("""
    SELECT * FROM events
    WHERE date_trunc('day', ts) > date_trunc('day', TIMESTAMP '2037-09-24 10:30:00' - INTERVAL 5000 DAY)
""")
def retention_survivors(spark, sf_dir):
    return retained(table(spark, sf_dir, "events"), "ts", 5000, now="2037-09-24 10:30:00")


@plan("SELECT doc_id, nullif(quality, 0) AS quality, nullif(toxic, 0) AS toxic FROM labels", name="falsy_to_null")
def falsy_null_copy(spark, sf_dir):
    return falsy_to_null(table(spark, sf_dir, "labels"), ["quality", "toxic"])

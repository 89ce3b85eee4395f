"""Seasonal expansion, latest-wide and as-of joins. User id is the vehicle, event type the sensor."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.times import timestamp_sequence
from tidemark.operators.asof import asof_join, asof_wide
from tidemark.operators.combine import with_each
from tidemark.operators.latest import latest_wide
from tidemark.plans.registry import FEW, MANY, MANY_SQL, SENSORS, many_sensors, plan, rows_per_split, table
from tidemark.session import materialize

#: The one vehicle the single-key form of the query selects.
SELECTED_VEHICLE = 7


def _sensor_ctes(latest: bool, where: str = "") -> str:
    """One relation per sensor, all rows or the latest per user."""
    ctes = []
    for i, s in enumerate(SENSORS, 1):
        rows = f"SELECT ts, user_id, value, event_id FROM events WHERE event_type = '{s}' {where}"
        if latest:
            rows = f"SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
        ctes.append(f"s{i} AS ({rows})")
    return "WITH " + ", ".join(ctes)


def _wide_sql(join: str, latest: bool, full_ts: bool = False, where: str = "") -> str:
    columns = ["s1.ts", "s1.user_id", "s1.value AS value_1"]
    joins = ["FROM s1"]
    for i in range(2, len(SENSORS) + 1):
        if full_ts:
            columns.append(f"s{i}.ts AS timestamp_{i}")
        columns.append(f"s{i}.value AS value_{i}")
        on = f"s1.user_id = s{i}.user_id" + (f" AND s1.ts >= s{i}.ts" if "ASOF" in join else "")
        joins.append(f"{join} s{i} ON {on}")
    return f"{_sensor_ctes(latest, where)} SELECT {', '.join(columns)} {' '.join(joins)}"


@plan("""
    SELECT n_name AS country, r_name AS category,
           TIMESTAMP '2022-01-01' + to_minutes(CAST(x - 1 AS BIGINT)) AS ts,
           CAST(trunc(visits * (n_nationkey + 1)) AS BIGINT) AS visits,
           round(visits * price, 4) AS sales
    FROM nation, (SELECT r_name, r_regionkey * 10.0::DOUBLE + 5.5::DOUBLE AS price FROM region),
         (SELECT c_custkey + 1 AS x,
                 ((c_custkey + 1) / 100.0::DOUBLE) * (1 + 0.5::DOUBLE * cos((c_custkey + 1) * 6.28::DOUBLE / 90)) AS visits
          FROM customer)
""")
def cross_join_seasonal(spark, sf_dir):
    x = F.col("c_custkey") + 1
    timeline = table(spark, sf_dir, "customer").select(
        timestamp_sequence(x, "2022-01-01", 60_000_000).cast("timestamp_ntz").alias("ts"),
        (x / 100.0 * (1 + 0.5 * F.cos(x * 6.28 / 90))).alias("v"),
    )
    countries = table(spark, sf_dir, "nation").select(F.col("n_name").alias("country"), (F.col("n_nationkey") + 1).alias("m"))
    categories = table(spark, sf_dir, "region").select(
        F.col("r_name").alias("category"), (F.col("r_regionkey") * 10.0 + 5.5).alias("price")
    )
    return with_each(timeline, countries, categories).select(
        "country",
        "category",
        "ts",
        (F.col("v") * F.col("m")).cast("bigint").alias("visits"),
        F.round(F.col("v") * F.col("price"), 4).alias("sales"),
    )


@plan(_wide_sql("LEFT JOIN", latest=True))
def latest_wide_left(spark, sf_dir):
    return latest_wide(table(spark, sf_dir, "events"), "user_id", "event_type", SENSORS, "ts", "value", ["event_id"])


@plan(_wide_sql("JOIN", latest=True, full_ts=True))
def latest_wide_complete(spark, sf_dir):
    return latest_wide(
        table(spark, sf_dir, "events"),
        "user_id", "event_type", SENSORS, "ts", "value", ["event_id"],
        how="inner", full_ts=True,
    )


@plan(_wide_sql("JOIN", latest=True, where=f"AND user_id = {SELECTED_VEHICLE}"))
def latest_wide_single_key(spark, sf_dir):
    one = table(spark, sf_dir, "events").where(F.col("user_id") == SELECTED_VEHICLE)
    return latest_wide(one, "user_id", "event_type", SENSORS, "ts", "value", ["event_id"], how="inner")


@plan("""
    SELECT l.event_id, l.ts, l.user_id, l.value, r.value AS view_value, r.ts AS view_ts
    FROM (SELECT * FROM events WHERE event_type = 'click') l
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') r
      ON l.user_id = r.user_id AND l.ts >= r.ts
""", name="asof_join")
def asof_join_pair(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "ts", "user_id", "value")
    views = events.where("event_type = 'view'")
    return asof_join(clicks, views, ["user_id"], "ts", {"value": "view_value", "ts": "view_ts"}, tiebreak=["event_id"])


@plan(_wide_sql("ASOF LEFT JOIN", latest=False))
def asof_join_multi(spark, sf_dir):
    return asof_wide(table(spark, sf_dir, "events"), "user_id", "event_type", SENSORS, "ts", "value", ["event_id"])


@plan(_wide_sql("ASOF LEFT JOIN", latest=False, full_ts=True))
def asof_join_full_ts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return asof_wide(events, "user_id", "event_type", SENSORS, "ts", "value", ["event_id"], full_ts=True)


@plan("""
    WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders),
         last_per_day AS (SELECT * FROM o QUALIFY row_number() OVER
                          (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)
    SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, x.o_custkey, r.o_orderkey AS last_order, r.o_totalprice AS last_price
    FROM lineitem l JOIN o x ON l.l_orderkey = x.o_orderkey
    ASOF LEFT JOIN last_per_day r ON x.o_custkey = r.o_custkey AND l.l_shipdate >= r.o_orderdate
""")
def asof_join_orders(spark, sf_dir):
    """The customer's newest order at the time each line shipped; several orders a day tie on time."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    shipped = lines.join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
    )
    return asof_join(
        # the key count and the join itself both read it
        materialize(shipped.select("l_orderkey", "l_linenumber", "l_shipdate", "o_custkey"), "shipped"),
        orders,
        ["o_custkey"],
        "l_shipdate",
        {"o_orderkey": "last_order", "o_totalprice": "last_price"},
        right_ts="o_orderdate",
        tiebreak=["o_orderkey"],
    )


_FEW_KEYS = f"events AS (SELECT * REPLACE (user_id % {FEW} AS user_id) FROM events), "


@plan(_wide_sql("ASOF LEFT JOIN", latest=False).replace("WITH ", "WITH " + _FEW_KEYS, 1))
def asof_join_split(spark, sf_dir):
    """The as-of chain over a few keys, each of them split over tasks."""
    events = table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id") % FEW)
    most = rows_per_split(events)
    return asof_wide(events, "user_id", "event_type", SENSORS, "ts", "value", ["event_id"], rows_per_key=most)


#: Every sensor's last reading at or before the first sensor's, as of its time; ties by the hashed number.
_MANY_ASOF = """
    WITH {readings},
    driving AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY ts, tie NULLS FIRST) AS n FROM readings WHERE sensor = 's0'),
    last_at AS (SELECT d.vehicle, d.n, r.sensor, last(r.value ORDER BY r.ts, r.tie NULLS FIRST) AS value
                FROM driving d JOIN readings r ON r.vehicle = d.vehicle AND r.ts <= d.ts WHERE r.sensor <> 's0' GROUP BY ALL)
    SELECT d.ts, d.vehicle, d.value AS value_1, {columns}
    FROM driving d LEFT JOIN last_at l ON l.vehicle = d.vehicle AND l.n = d.n GROUP BY d.vehicle, d.n, d.ts, d.value
"""


@plan(_MANY_ASOF.format(readings=MANY_SQL, columns=", ".join(f"max(l.value) FILTER (WHERE l.sensor = '{s}') AS value_{i}" for i, s in enumerate(MANY[1:], 2))))
def asof_join_110(spark, sf_dir):
    return asof_wide(many_sensors(spark, sf_dir), "vehicle", "sensor", MANY, "ts", "value", ["tie"])


@plan(f"""
    WITH {MANY_SQL},
    newest AS (SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY vehicle, sensor ORDER BY ts DESC, tie DESC NULLS LAST) = 1)
    SELECT max(ts) FILTER (WHERE sensor = 's0') AS ts, vehicle,
           {', '.join(f"max(value) FILTER (WHERE sensor = '{s}') AS value_{i}" for i, s in enumerate(MANY, 1))}
    FROM newest GROUP BY vehicle HAVING count(*) FILTER (WHERE sensor = 's0') > 0
""")
def latest_wide_110(spark, sf_dir):
    return latest_wide(many_sensors(spark, sf_dir), "vehicle", "sensor", MANY, "ts", "value", ["tie"])

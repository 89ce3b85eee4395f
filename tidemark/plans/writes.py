"""Queries that go through written tables: upserts, copies, retention, routing, ELT."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import datasets, snapshots
from tidemark.functions import times
from tidemark.operators import maintenance
from tidemark.operators.combine import union_all
from tidemark.operators.copying import copy_snapshot
from tidemark.operators.latest_table import LatestTable, read_latest, update_latest
from tidemark.operators.upsert import append_strict, upsert, upsert_into
from tidemark.operators.zones import append_clustered, read_ranges
from tidemark.plans.aggregates import daily_readings
from tidemark.plans.registry import plan, table
from tidemark.plans.scalars import GEOHASH_SQL, customer_places
from tidemark.session import materialize, new_database, scratch_path
from tidemark.sinks.files import export_csv, import_csv, read_routed, route_by_key, write_observed
from tidemark.sources import catalog
from tidemark.sources.csv_files import read_csv
from tidemark.sources.quoted_csv import load_csv
from tidemark.timetable import (
    PARTITION_COLUMN,
    TimeTable,
    create_statement,
    create_table,
    insert_into,
    read_time_table,
    set_dedup,
    time_between,
    write_time_table,
)


@plan("""
    WITH batches AS (
      SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, user_id, event_type, value, event_id, 1 AS batch FROM events
      UNION ALL
      SELECT CAST(date_trunc('day', ts) AS TIMESTAMP), user_id, event_type, value * 10, event_id, 2 FROM events WHERE event_type = 'purchase')
    SELECT day, user_id, event_type, value, event_id FROM batches
    QUALIFY row_number() OVER (PARTITION BY day, user_id ORDER BY batch DESC, event_id DESC) = 1
""")
def upsert_table(spark, sf_dir):
    """A batch of all readings, then one of corrected purchases, upserted into a DAY table."""
    readings = daily_readings(table(spark, sf_dir, "events"))
    target = TimeTable(readings.schema, ts="day", unit="DAY", keys=("day", "user_id"))
    path = scratch_path(spark, "upsert-target")
    upsert(readings, path, target, ["event_id"])
    corrected = readings.where("event_type = 'purchase'").withColumn("value", F.col("value") * 10)
    upsert(corrected, path, target, ["event_id"])
    return read_time_table(spark, path, target).drop(PARTITION_COLUMN)


@plan("""
    WITH readings AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, user_id, event_type, value, event_id FROM events),
         batches AS (SELECT *, 1 AS batch FROM readings
                     UNION ALL SELECT day, user_id, event_type, value * 10, event_id, 2 FROM readings WHERE event_type = 'purchase')
    SELECT * FROM (SELECT day, user_id, event_type, value, event_id FROM batches
                   QUALIFY row_number() OVER (PARTITION BY day, user_id ORDER BY batch DESC, event_id DESC) = 1)
    UNION ALL SELECT day, user_id, event_type, value, event_id FROM readings WHERE event_type = 'error'
""")
def dedup_disable(spark, sf_dir):
    """Two upserts into a catalog table, then dedup is switched off and the errors are appended."""
    readings = daily_readings(table(spark, sf_dir, "events"))
    name = f"{new_database(spark)}.readings"
    create_table(spark, name, TimeTable(readings.schema, ts="day", unit="MONTH", keys=("day", "user_id")))
    upsert_into(spark, readings, name, ["event_id"])
    corrected = readings.where("event_type = 'purchase'").withColumn("value", F.col("value") * 10)
    upsert_into(spark, corrected, name, ["event_id"])
    set_dedup(spark, name, False)
    upsert_into(spark, readings.where("event_type = 'error'"), name, ["event_id"])
    return spark.table(name).drop(PARTITION_COLUMN)


@plan("""
    WITH batches AS (
      SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(date_trunc('day', ts) AS TIMESTAMP) END AS day, user_id, value, event_id, event_id % 2 AS batch FROM events)
    SELECT day, user_id, value, event_id FROM batches
    QUALIFY row_number() OVER (PARTITION BY day, user_id ORDER BY batch DESC, event_id DESC) = 1
""")
def upsert_null_time(spark, sf_dir):
    """Two batches of readings, a third of them without a time: NULL is a key like any other."""
    events = table(spark, sf_dir, "events")
    day = F.when(F.col("event_id") % 3 != 0, F.date_trunc("DAY", "ts").cast("timestamp_ntz")).alias("day")
    readings = events.select(day, "user_id", "value", "event_id")
    target = TimeTable(readings.schema, ts="day", unit="HOUR", keys=("day", "user_id"))
    path = scratch_path(spark, "null-times")
    for batch in (0, 1):
        upsert(readings.where(F.col("event_id") % 2 == batch), path, target, ["event_id"])
    return read_time_table(spark, path, target).drop(PARTITION_COLUMN)


@plan("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity FROM lineitem", name="append_table")
def append_rows(spark, sf_dir):
    """Lines by return flag, appended batch by batch to a YEAR table."""
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    target = TimeTable(rows.schema, ts="l_shipdate", unit="YEAR")
    path = scratch_path(spark, "append-target")
    for batch in (rows.where(lines["l_returnflag"] == "R"), rows.where(lines["l_returnflag"] != "R")):
        write_time_table(batch, path, target)
    return read_time_table(spark, path, target).drop(PARTITION_COLUMN)


@plan("SELECT event_id, ts, user_id, value FROM events")
def append_unique(spark, sf_dir):
    """Two batches whose keys do not meet pass the unique constraint."""
    events = table(spark, sf_dir, "events")
    rows = events.select("event_id", "ts", "user_id", "value")
    target = TimeTable(rows.schema, ts="ts", unit="DAY", keys=("ts", "event_id"))
    path = scratch_path(spark, "strict-target")
    append_strict(rows.where(events["event_type"] == "view"), path, target)
    append_strict(rows.where(events["event_type"] != "view"), path, target)
    return read_time_table(spark, path, target).drop(PARTITION_COLUMN)


@plan("""
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-02-10' AND TIMESTAMP '1997-11-20'
""")
def partition_pruned_range(spark, sf_dir):
    """A time range over a MONTH table reads only the months it covers."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    target = TimeTable(rows.schema, ts="o_orderdate", unit="MONTH")
    path = scratch_path(spark, "pruned-target")
    write_time_table(rows, path, target)
    stored = read_time_table(spark, path, target)
    return time_between(stored, "o_orderdate", "1997-02-10", "1997-11-20", unit="MONTH").drop(PARTITION_COLUMN)


@plan("""
    SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 2 = 0 THEN value ELSE -1 END AS value, props
    FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0
""")
def table_copy(spark, sf_dir):
    """A copy into a target that holds other rows, and older ones of the same keys."""
    events = table(spark, sf_dir, "events")
    database = new_database(spark)
    facts = TimeTable(events.schema, ts="ts", unit="DAY", keys=("ts", "event_id"))
    for name, rows in (("origin", events.where("event_id % 2 = 0")), ("copy", events.where("event_id % 3 = 0").withColumn("value", F.lit(-1.0)))):
        create_table(spark, f"{database}.{name}", facts)
        insert_into(spark, rows, f"{database}.{name}")
    maintenance.copy_table(spark, f"{database}.origin", f"{database}.copy")
    return spark.table(f"{database}.copy").drop(PARTITION_COLUMN)


@plan("""
    SELECT 'readings' AS name, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS rows, 'ts' AS designated, true AS dedup
    FROM events GROUP BY 2
""")
def catalog_scan(spark, sf_dir):
    """What the catalog says of a table's partitions, next to the rows in them."""
    events = table(spark, sf_dir, "events")
    database = new_database(spark)
    create_table(spark, f"{database}.readings", TimeTable(events.schema, ts="ts", unit="DAY", keys=("ts", "event_id")))
    insert_into(spark, events, f"{database}.readings")
    listed = catalog.partitions(spark, f"{database}.readings")
    facts = catalog.tables(spark, database).select("name", F.col("designatedTimestamp").alias("designated"), "dedup")
    sizes = spark.table(f"{database}.readings").groupBy(PARTITION_COLUMN).agg(F.count("*").alias("rows"))
    return listed.join(sizes, PARTITION_COLUMN).crossJoin(facts).select(
        "name", F.col(PARTITION_COLUMN).cast("date").alias("day"), "rows", "designated", "dedup"
    )


#: Literal rows of a small table: a sensor's name and factor.
_FACTORS = [("view", 1.0), ("click", 0.5), ("purchase", 2.0), ("nobody", 9.0), ("error", None)]


@plan(f"""
    SELECT event_id, event_type, value * factor AS scaled
    FROM events LEFT JOIN (VALUES {', '.join(f"('{s}', {'NULL' if f is None else f}::DOUBLE)" for s, f in _FACTORS)}) v(sensor, factor) ON sensor = event_type
""")
def insert_values(spark, sf_dir):
    """Rows given as literals, in two inserts, joined with the readings they scale."""
    name = f"{new_database(spark)}.factors"
    spark.sql(f"CREATE TABLE {name} (sensor string, factor double) USING parquet")
    for rows in (_FACTORS[:2], _FACTORS[2:]):
        maintenance.insert_rows(spark, name, rows)
    readings = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    factors = spark.table(name)
    scaled = readings.join(factors, readings["event_type"] == factors["sensor"], "left")
    return materialize(scaled.select("event_id", "event_type", (F.col("value") * F.col("factor")).alias("scaled")), "scaled")


@plan("SELECT event_id, ts, user_id, value FROM events WHERE event_id % 4 <> 2")
def bulk_tables(spark, sf_dir):
    """Four tables made in bulk take the readings by event number; one is dropped, the rest is read; then all are dropped."""
    readings = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    database, count = new_database(spark), 4
    columns = ", ".join(f"{c} {t}" for c, t in readings.dtypes)
    names = maintenance.create_tables(spark, f"{database}.readings_", count, f"CREATE TABLE {{table_name}} ({columns}) USING parquet")
    for i, name in enumerate(names):
        insert_into(spark, readings.where(F.col("event_id") % count == i), name)
    maintenance.drop_table(spark, names[2])
    kept = materialize(union_all(*[spark.table(n) for n in names if spark.catalog.tableExists(n)]), "bulk")
    maintenance.drop_tables(spark, f"{database}.readings_", count)
    return kept if not spark.catalog.listTables(database) else kept.limit(0)


@plan("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, year(o_orderdate) = CAST(strftime(o_orderdate, '%Y') AS BIGINT) AS in_its_part FROM orders
""")
def create_from_statement(spark, sf_dir):
    """The text of a CREATE statement is run as it is; rows then lie in the parts it declares."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    name = f"{new_database(spark)}.orders"
    spark.sql(create_statement(name, TimeTable(orders.schema, ts="o_orderdate", unit="YEAR")))
    insert_into(spark, orders, name)
    return spark.table(name).select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), (F.year("o_orderdate").cast("string") == F.col(PARTITION_COLUMN)).alias("in_its_part")
    )


@plan("""
    SELECT event_id, ts, value FROM events
    WHERE date_trunc('day', ts) > date_trunc('day', TIMESTAMP '2037-09-20 08:00:00' - INTERVAL 5000 DAY)
""")
def retention_drop(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    name = f"{new_database(spark)}.readings"
    create_table(spark, name, TimeTable(rows.schema, ts="ts", unit="DAY"))
    insert_into(spark, rows, name)
    maintenance.drop_expired_partitions(spark, name, 5000, now="2037-09-20 08:00:00")
    return spark.table(name).drop(PARTITION_COLUMN)


@plan("SELECT event_id, ts, value, epoch_us(ts) AS ln_timestamp FROM events")
def alter_and_update(spark, sf_dir):
    """ADD COLUMN, then a whole-table UPDATE that fills it."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    name = f"{new_database(spark)}.readings"
    create_table(spark, name, TimeTable(rows.schema))
    insert_into(spark, rows, name)
    maintenance.add_column(spark, name, "ln_timestamp", "bigint")
    maintenance.update_column(spark, name, "ln_timestamp", times.micros("ts"))
    return spark.table(name)


@plan("""
    SELECT ts, user_id, CAST(trunc(value * 3.7::DOUBLE) AS BIGINT) AS visits, CAST(trunc(value) AS INTEGER) AS products,
           value / 3 AS sales
    FROM events
""")
def insert_select_cast(spark, sf_dir):
    """INSERT … SELECT of doubles into integer columns truncates toward zero."""
    name = f"{new_database(spark)}.stats"
    schema = "ts timestamp_ntz, user_id bigint, visits bigint, products int, sales double"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet")
    value = F.col("value")
    rows = table(spark, sf_dir, "events").select(
        "ts", "user_id", (value * 3.7).alias("visits"), value.alias("products"), (value / 3).alias("sales")
    )
    insert_into(spark, rows, name)
    return spark.table(name)


@plan("SELECT count(*) AS rows, count(*) AS observed FROM events")
def observed_ingest(spark, sf_dir):
    """Rows written, as the write itself reported them and as read back."""
    path = scratch_path(spark, "observed")
    seen = write_observed(table(spark, sf_dir, "events"), path)
    return spark.read.parquet(path).agg(F.count("*").alias("rows")).withColumn("observed", F.lit(seen["rows"]).cast("bigint"))


@plan("SELECT event_id, ts, '00' || (user_id % 10) AS route, event_type, value FROM events", name="route_by_key")
def route_rows(spark, sf_dir):
    """Routes that look like numbers stay the text they are."""
    path = scratch_path(spark, "routed")
    route = F.concat(F.lit("00"), F.col("user_id") % 10).alias("route")
    rows = table(spark, sf_dir, "events").select("event_id", "ts", route, "event_type", "value")
    route_by_key(rows, "route", path)
    return read_routed(spark, path, rows.schema)


@plan("""
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def csv_import(spark, sf_dir):
    """Bulk import: append, replace, append again."""
    suppliers = table(spark, sf_dir, "supplier")
    path, name = scratch_path(spark, "import-csv"), f"{new_database(spark)}.suppliers"
    export_csv(suppliers, path)
    for overwrite in (False, True, False):
        import_csv(spark, path, name, overwrite, schema=suppliers.schema)
    return spark.table(name)


@plan("""
    SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS at, ts, event_type, CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS VARCHAR) AS mixed FROM events
""")
def csv_import_inferred(spark, sf_dir):
    """Types found by looking at all values: 12-hour times, ISO times, and a column that is a number but for some."""
    events = table(spark, sf_dir, "events")
    mixed = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("user_id").cast("string")).alias("mixed")
    path, name = scratch_path(spark, "inferred-csv"), f"{new_database(spark)}.readings"
    export_csv(events.select("event_id", F.date_format("ts", times.CLOCK_12H).alias("at"), "ts", "event_type", mixed), path)
    import_csv(spark, path, name, overwrite=True)
    rows = spark.table(name)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in rows.dtypes if t == "timestamp"})


@plan(f"""
    SELECT TIMESTAMP '2023-09-04' AS "UpdatedAt", concat('S', c_custkey) AS "SensorName", 'Water' AS "SensorType",
           c_acctbal / 10000 * 80 AS "Latitude", CAST(c_custkey % 360 - 180 AS DOUBLE) AS "Longitude", g7c AS "G7c"
    FROM ({GEOHASH_SQL}) JOIN customer USING (c_custkey)
""")
def elt_locations(spark, sf_dir):
    """Landed CSV to a typed YEAR table with a geohash, without a staging table."""
    places = customer_places(table(spark, sf_dir, "customer"))
    path, name = scratch_path(spark, "locations-csv"), f"{new_database(spark)}.locations"
    landed = places.select(
        F.concat(F.lit("S"), "c_custkey").alias("SensorName"), F.lit("Water").alias("SensorType"), F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude")
    )
    export_csv(landed, path)
    raw = read_csv(spark, path, "SensorName string, SensorType string, Latitude string, Longitude string")
    create_table(spark, name, datasets.target("sensor_locations"))
    maintenance.truncate_table(spark, name)
    insert_into(spark, datasets.locations(raw), name)
    return spark.table(name).drop(PARTITION_COLUMN).withColumn("UpdatedAt", F.col("UpdatedAt").cast("timestamp_ntz"))


_DAILY = "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, user_id, event_type, value, event_id FROM events"


@plan(f"""
    WITH readings AS ({_DAILY}),
         batches AS (SELECT *, 1 AS batch FROM readings
                     UNION ALL SELECT day, user_id, event_type, value * 10, event_id, 2 FROM readings WHERE event_type = 'purchase')
    SELECT 'before' AS snapshot, day, user_id, event_type, value, event_id FROM readings
    QUALIFY row_number() OVER (PARTITION BY day, user_id ORDER BY event_id DESC) = 1
    UNION ALL
    SELECT * FROM (SELECT 'after', day, user_id, event_type, value, event_id FROM batches
                   QUALIFY row_number() OVER (PARTITION BY day, user_id ORDER BY batch DESC, event_id DESC) = 1)
""")
def snapshot_upsert(spark, sf_dir):
    """Two upserts into a snapshot table, one writer cut off in between; the snapshot before the second stays as it was."""
    readings = daily_readings(table(spark, sf_dir, "events"))
    layout, path = TimeTable(readings.schema, ts="day", unit="DAY", keys=("day", "user_id")), scratch_path(spark, "snapshots")
    first = snapshots.upsert(readings, path, layout, ["event_id"])
    # written, but never committed
    snapshots.write_as_arranged(layout.stamp(readings.withColumn("value", F.lit(-1.0))), path, layout)
    corrected = readings.where("event_type = 'purchase'").withColumn("value", F.col("value") * 10)
    second = snapshots.upsert(corrected, path, layout, ["event_id"])
    told = [
        snapshots.read(spark, path, layout, s.version).drop(PARTITION_COLUMN).withColumn("snapshot", F.lit(name))
        for name, s in (("before", first), ("after", second))
    ]
    return told[0].unionByName(told[1])


@plan("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_maintained(spark, sf_dir):
    """A latest-per-key table kept up to date by three batches, of which later ones hold older rows too."""
    events = table(spark, sf_dir, "events")
    latest, path = LatestTable(events.schema, "ts", ("user_id", "event_type"), ("event_id",), buckets=16), scratch_path(spark, "latest")
    for batch in (2, 0, 1):
        update_latest(events.where(F.col("event_id") % 3 == batch), path, latest)
    return read_latest(spark, path, latest).select(*events.columns)


@plan("""
    SELECT event_id, ts, user_id, value FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00' AND user_id BETWEEN 10 AND 40
""")
def zone_skipping(spark, sf_dir):
    """A range of times and keys over a MONTH table clustered by both: only files whose extents meet it are opened."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    layout, path = TimeTable(rows.schema, ts="ts", unit="MONTH"), scratch_path(spark, "clustered")
    append_clustered(rows, path, layout, ["ts", "user_id"], rows_per_file=max(1, rows.count() // 40))
    found = read_ranges(spark, path, layout, {"ts": ("2024-01-05 06:00:00", "2024-01-12 18:00:00"), "user_id": (10, 40)})
    if found.opened >= found.files:
        raise AssertionError(f"all {found.files} files were opened")
    return found.rows.drop(PARTITION_COLUMN)


@plan("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def copy_resumed(spark, sf_dir):
    """A copy stopped after two steps and started again, by a ledger of the files it has."""
    events = table(spark, sf_dir, "events")
    layout = TimeTable(events.schema, ts="ts", unit="DAY")
    source, target = scratch_path(spark, "copy-source"), scratch_path(spark, "copy-target")
    for batch in (0, 1):
        snapshots.append(events.where(F.col("event_id") % 2 == batch), source, layout)
    size = sum(p.bytes for p in snapshots.latest(spark, source).parts)
    for steps in (2, None):
        copy_snapshot(spark, source, target, layout, step_bytes=max(1, size // 6), most_steps=steps)
    return snapshots.read(spark, target, layout).drop(PARTITION_COLUMN)


@plan("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_quoted_parallel(spark, sf_dir):
    """Texts with line breaks, quotes and commas from CSV files that are cut into splits wherever they end."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "quoted-csv")
    export_csv(docs, path, page_rows=0)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return load_csv(spark, path, docs.schema, split_bytes=max(10_000, size // 24)).rows


@plan("""
    SELECT event_id, CASE WHEN event_id % 7 = 3 THEN NULL ELSE value END AS value,
           CASE WHEN event_id % 7 = 3 THEN 'value is no double' WHEN event_id % 7 = 5 THEN 'not 3 columns' END AS reason
    FROM events
""")
def csv_rejects(spark, sf_dir):
    """Lines with a value that is no number, or with a column too many, come back with the reason; all others as rows."""
    events, i = table(spark, sf_dir, "events"), F.col("event_id")
    value = F.when(i % 7 == 3, "n/a").otherwise(F.col("value").cast("string"))
    line = F.concat_ws(",", i, F.concat(F.lit('"'), "event_type", F.lit('\n""x"""')), value, F.when(i % 7 == 5, "more"))
    path = scratch_path(spark, "rejects-csv")
    events.select(line).write.text(path)
    load = load_csv(spark, path, "event_id bigint, event_type string, value double", header=False)
    if load.counts["good"] + load.counts["rejected"] != load.counts["records"]:
        raise AssertionError(f"records are missing: {load.counts}")
    number = F.regexp_extract("text", r"^(\d+),", 1).cast("bigint").alias("event_id")
    kept = F.when(F.col("reason") == "not 3 columns", F.regexp_extract("text", r',([^,"]*),more$', 1).cast("double")).alias("value")
    return load.rows.select("event_id", "value", F.lit(None).cast("string").alias("reason")).unionByName(load.rejects.select(number, kept, "reason"))

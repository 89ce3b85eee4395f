"""Scans, filters, projections and text sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.arrays import flatten_dataset
from tidemark.operators.combine import concat_with_key, union_all, union_distinct
from tidemark.plans.registry import plan, table
from tidemark.session import folder_names, rename_files, scratch_path
from tidemark.sinks.files import CSV_TEXT, export_csv, json_row
from tidemark.sinks.line_protocol import to_lines, write_lines
from tidemark.sources.csv_files import infer_columns, read_csv, read_csv_text, with_route_key
from tidemark.sources.json_files import prediction_rows
from tidemark.sources.line_protocol import count_bad, read_lines, select_table
from tidemark.sources.manifest import column_type, manifest_columns
from tidemark.timetable import time_between


@plan("SELECT * FROM events")
def scan_events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@plan("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def csv_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-csv")
    export_csv(events, path)
    return read_csv(spark, path, events.schema)


@plan("""
    SELECT * FROM (
      SELECT 0 AS position, 'event_id' AS column_name,
             CASE WHEN count(try_cast(event_id AS BIGINT)) = count(*) THEN 'LONG' ELSE 'SYMBOL' END AS column_type FROM events
      UNION ALL SELECT 1, 'ts', CASE WHEN count(try_cast(ts AS TIMESTAMP)) = count(*) THEN 'TIMESTAMP' ELSE 'SYMBOL' END FROM events
      UNION ALL SELECT 2, 'user_id', CASE WHEN count(try_cast(user_id AS BIGINT)) = count(*) THEN 'LONG' ELSE 'SYMBOL' END FROM events
      UNION ALL SELECT 3, 'event_type', CASE WHEN max(length(event_type)) > 30 THEN 'STRING' ELSE 'SYMBOL' END FROM events
      UNION ALL SELECT 4, 'value', CASE WHEN count(try_cast(CAST(value AS VARCHAR) AS DOUBLE)) = count(*) THEN 'DOUBLE' ELSE 'SYMBOL' END FROM events
      UNION ALL SELECT 5, 'props', CASE WHEN max(length(props)) > 30 THEN 'STRING' ELSE 'SYMBOL' END FROM events)
""", name="infer_schema")
def infer_types(spark, sf_dir):
    path = scratch_path(spark, "infer-csv")
    export_csv(table(spark, sf_dir, "events"), path)
    return infer_columns(read_csv_text(spark, path))


@plan("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_documents_roundtrip(spark, sf_dir):
    """Texts with line breaks, quotes and commas through CSV files."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents-csv")
    export_csv(docs, path, page_rows=1000)
    return read_csv(spark, path, docs.schema, multi_line=True)


@plan("SELECT event_id, ts, user_id FROM events")
def csv_positional_subset(spark, sf_dir):
    """The first three of six columns, under other names in the file."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "positional-csv")
    export_csv(events.toDF(*[f"column {i}" for i in range(6)]), path)
    return read_csv(spark, path, events.select("event_id", "ts", "user_id").schema)


@plan("""
    SELECT event_id, ts, user_id, event_type, value, props, right(event_type, 2) AS route FROM events
""")
def csv_route_key(spark, sf_dir):
    """Files named after the event type of their rows, whatever types there are; the last two letters of a name are the route."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "routes-csv")
    # a type of no name is a route of its own
    named = events.withColumn("_type", F.coalesce("event_type", F.lit("--"))).hint("rebalance", "_type")
    named.write.partitionBy("_type").options(header=True, **CSV_TEXT).csv(f"{path}-parts")
    for folder in folder_names(spark, f"{path}-parts"):
        rename_files(spark, f"{path}-parts/{folder}", f"{path}/{folder.split('=', 1)[1]}.csv")
    rows = with_route_key(read_csv(spark, f"{path}/*.csv", events.schema))
    return rows.withColumn("route", F.nullif("route", F.lit("--")))


_BASES = ["int8", "timestamp", "character varying", "float8", "geometry"]


@plan(f"""
    SELECT event_id, position, column_name,
           CASE base WHEN 'int8' THEN 'LONG' WHEN 'timestamp' THEN 'TIMESTAMP' WHEN 'character varying' THEN 'SYMBOL' WHEN 'float8' THEN 'DOUBLE' ELSE 'STRING' END AS column_type
    FROM (SELECT event_id, 0 AS position, event_type AS column_name, ['{"', '".join(_BASES)}'][event_id % 5 + 1] AS base FROM events
          UNION ALL SELECT event_id, 1, 'user ' || user_id, 'float8' FROM events)
""")
def manifest_schema(spark, sf_dir):
    """A manifest for every event, each of two columns, read back as column types."""
    base = F.get(F.array(*[F.lit(b) for b in _BASES]), (F.col("event_id") % 5).cast("int"))

    def element(name, kind):
        return F.struct(name.alias("name"), F.struct(kind.alias("base")).alias("type"))

    elements = F.array(element(F.col("event_type"), base), element(F.concat(F.lit("user "), "user_id"), F.lit("float8")))
    path = scratch_path(spark, "manifest")
    told = table(spark, sf_dir, "events").select("event_id", F.struct(elements.alias("elements")).alias("schema"))
    told.select(F.to_json(F.struct("event_id", "schema"))).write.text(path)
    return manifest_columns(spark, path, by="event_id bigint", multi_line=False)


@plan("""
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'INT' WHEN 1 THEN 'DOUBLE' WHEN 2 THEN 'SYMBOL' WHEN 3 THEN 'TIMESTAMP' ELSE 'STRING' END AS column_type
    FROM events
""")
def type_mapping(spark, sf_dir):
    """Warehouse type names in a column, as the types they become."""
    names = F.array(*[F.lit(n) for n in ("int4", "float", "bpchar", "timestamptz", "geometry")])
    base = F.get(names, (F.col("event_id") % 5).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", column_type(base).alias("column_type"))


@plan("SELECT * FROM events WHERE event_type = 'purchase'")
def filter_eq(spark, sf_dir):
    return table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")


@plan("""
    SELECT * FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01 00:00:00' AND TIMESTAMP '1996-09-30 23:59:59.999'
""")
def filter_time_between(spark, sf_dir):
    return time_between(table(spark, sf_dir, "orders"), "o_orderdate", "1996-03-01", "1996-09-30 23:59:59.999")


@plan("""
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net_price,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross_price, l_returnflag AS flag
    FROM lineitem
""")
def project_computed(spark, sf_dir):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        net.alias("net_price"),
        (net * (1 + F.col("l_tax"))).alias("gross_price"),
        F.col("l_returnflag").alias("flag"),
    )


@plan("SELECT o_orderkey, 'UK' AS country, CAST(67.53 AS DOUBLE) AS avg_unit_price FROM orders")
def literal_relation(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lit("UK").alias("country"), F.lit(67.53).alias("avg_unit_price")
    )


@plan("""
    SELECT concat('events,event_type=', event_type, ' user_id=', user_id, 'i,value=', value,
                  ',props="', replace(props, '"', '\\"'), '" ', epoch_us(ts) * 1000) AS line
    FROM events
""")
def to_line_protocol(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return to_lines(events, "events", ["event_type"], ["user_id", "value", "props"], "ts", name="line")


@plan("SELECT event_id, ts, user_id, event_type, value FROM events")
def frame_sink(spark, sf_dir):
    """A frame with symbols and a designated time to lines, and back."""
    events = table(spark, sf_dir, "events").drop("props")
    path = scratch_path(spark, "frame-lines")
    write_lines(events, path, "readings", ["event_type"], ["event_id", "user_id", "value"], "ts")
    back = select_table(read_lines(spark, path), "readings", ["event_type"], {"event_id": "bigint", "user_id": "bigint", "value": "double"}, "ts")
    return back.withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*events.columns)


@plan("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def line_protocol_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "events-lines")
    fields = {"event_id": "bigint", "user_id": "bigint", "value": "double", "props": "string"}
    write_lines(table(spark, sf_dir, "events"), path, "events", ["event_type"], list(fields), "ts")
    back = select_table(read_lines(spark, path), "events", ["event_type"], fields, ts="ts")
    return back.select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props"
    )


@plan("""
    SELECT event_id, value, (SELECT count(*) FROM events WHERE event_id % 4 = 0) AS malformed, (SELECT count(*) FROM events WHERE event_id % 4 = 1) AS unreadable
    FROM events WHERE event_id % 4 > 1
""")
def line_protocol_bad_lines(spark, sf_dir):
    """A repeated symbol, a line without a table, a field without a value, and a number that is none: counted, not lost."""
    line = F.expr("""
        CASE event_id % 12 WHEN 0 THEN concat('ev,a=1,a=2 id=', event_id, 'i 5') WHEN 4 THEN concat(' id=', event_id, 'i 5')
          WHEN 8 THEN concat('ev id=,v=1 ', event_id)
          ELSE concat('ev,k=x id=', event_id, 'i,v=', if(event_id % 4 = 1, 'abc', cast(value AS string)), ' ', event_id) END
    """)
    path, fields = scratch_path(spark, "bad-lines"), {"id": "bigint", "v": "double"}
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    parsed = read_lines(spark, path)
    bad = count_bad(parsed, fields).select("malformed", "unreadable")
    rows = select_table(parsed, "ev", ["k"], fields).where("v IS NOT NULL")
    return rows.select(F.col("id").alias("event_id"), F.col("v").alias("value")).crossJoin(bad)


@plan("SELECT doc_id, text, lang, source, n_chars FROM documents")
def line_protocol_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "documents-lines")
    fields = {"doc_id": "bigint", "text": "string", "n_chars": "bigint"}
    write_lines(table(spark, sf_dir, "documents"), path, "free text", ["lang", "source"], list(fields))
    back = select_table(read_lines(spark, path), "free text", ["lang", "source"], fields)
    return back.select("doc_id", "text", "lang", "source", "n_chars")


@plan("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )


@plan("""
    SELECT concat('{"event_id":', event_id, ',"ts":"', strftime(ts, '%Y-%m-%d %H:%M:%S.%f'),
                  '","error":', CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) ELSE 'null' END,
                  ',"props":"', replace(props, '"', '\\"'), '"}') AS json
    FROM events
""")
def to_json_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_type") == "error", F.col("user_id")).alias("error"), "props"
    )
    return rows.select(json_row(rows).alias("json"))


@plan("""
    SELECT event_id, event_type AS item FROM events
    UNION ALL SELECT event_id, CAST(user_id AS VARCHAR) FROM events
""")
def json_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    nested = F.array(F.array("event_type"), F.array(F.col("user_id").cast("string")))
    response = F.to_json(F.struct(nested.alias("dataset")))
    return events.select("event_id", response.alias("response")).select(
        "event_id", F.explode(flatten_dataset(F.col("response"))).alias("item")
    )


@plan("""
    SELECT concat('V', user_id) AS "vehicleId", CAST(NULL AS VARCHAR) AS "naptanId",
           regexp_replace(props, '[^\\p{L}\\p{N}_]', '_', 'g') AS "stationName", event_type AS "lineId",
           CAST(NULL AS VARCHAR) AS direction, CAST(NULL AS VARCHAR) AS bearing,
           CAST(NULL AS VARCHAR) AS "destinationNaptanId", CAST(NULL AS VARCHAR) AS "destinationName",
           CAST(NULL AS VARCHAR) AS "currentLocation", concat('to_', event_type) AS towards, 'bus' AS "modeName",
           CASE WHEN event_type <> 'error' THEN epoch_us(date_trunc('second', ts)) * 1000 END AS "expectedArrival",
           user_id AS "timeToStation", epoch_us(ts) * 1000 AS ts_ns
    FROM events
""")
def prediction_records(spark, sf_dir):
    none = F.lit(None).cast("string")
    raw = table(spark, sf_dir, "events").select(
        F.concat(F.lit("V"), "user_id").alias("vehicleId"),
        none.alias("naptanId"),
        F.col("props").alias("stationName"),
        F.col("event_type").alias("lineId"),
        none.alias("direction"),
        none.alias("bearing"),
        none.alias("destinationNaptanId"),
        none.alias("destinationName"),
        none.alias("currentLocation"),
        F.concat(F.lit("to "), "event_type").alias("towards"),
        F.lit("bus").alias("modeName"),
        F.when(F.col("event_type") == "error", "soon")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("expectedArrival"),
        F.col("user_id").alias("timeToStation"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
    )
    return prediction_rows(raw)


@plan("""
    SELECT o_orderkey AS key, o_totalprice AS price, o_orderdate AS day, 'orders' AS ticker FROM orders
    UNION ALL SELECT l_orderkey, l_extendedprice, l_shipdate, 'lineitem' FROM lineitem
""", name="concat_with_key")
def concat_keyed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("day")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("day"), F.col("l_extendedprice").alias("price"), F.col("l_orderkey").alias("key")
    )
    return concat_with_key({"orders": orders, "lineitem": lines}, "ticker")


@plan("""
    SELECT c_nationkey AS nationkey, 'customer' AS kind FROM customer
    UNION SELECT s_nationkey, 'supplier' FROM supplier
    UNION SELECT n_nationkey, 'nation' FROM nation
""", name="union_distinct")
def union_distinct_rows(spark, sf_dir):
    return union_distinct(
        table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("kind")),
        table(spark, sf_dir, "supplier").select("s_nationkey", F.lit("supplier")),
        table(spark, sf_dir, "nation").select("n_nationkey", F.lit("nation")),
    )


@plan("""
    SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier
""")
def union_all_by_name(spark, sf_dir):
    return union_all(
        table(spark, sf_dir, "customer").select(
            F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
        ),
        table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")),
    )

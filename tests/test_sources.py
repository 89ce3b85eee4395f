"""Files and text records on temporary folders."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions.arrays import flatten_dataset
from tidemark.session import scratch_path
from tidemark.sinks.files import export_csv, export_json, json_row, write_observed
from tidemark.sinks.line_protocol import to_lines
from tidemark.sources.csv_files import infer_columns, infer_schema, read_csv, read_csv_text, with_route_key
from tidemark.sources.json_files import SYMBOL_ORDER, read_predictions
from tidemark.sources.line_protocol import count_bad, parse_lines, read_lines, select_table
from tidemark.sources.manifest import WAREHOUSE_TYPES, manifest_columns, schema_of

SAMPLE = "ts timestamp, country string, category string, visits bigint, unique_visitors bigint, price double, sales double"


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def test_csv_by_position_with_route_key_and_quoted_commas(spark, tmp_path):
    head = "A,B,C,D,E,F,G\n"
    put(tmp_path, "sample_UK.csv", head + '2031-01-01T00:00:00.000000Z,UK,"HOME, GARDEN",1,2,3.5,4.5\n')
    put(tmp_path, "sample_ES.csv", head + "2031-01-01T00:01:00.250000Z,ES,MEN,5,6,,8.5\n")
    df = with_route_key(read_csv(spark, str(tmp_path / "*.csv"), SAMPLE, timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    got = {r["route"]: r for r in df.collect()}
    assert set(got) == {"UK", "ES"}
    assert got["UK"]["category"] == "HOME, GARDEN" and got["ES"]["price"] is None
    assert got["ES"]["ts"].microsecond == 250000


def test_malformed_csv_fails_unless_allowed(spark, tmp_path):
    path = put(tmp_path, "x_UK.csv", "a,b\n1,2\nx,4\n")
    with pytest.raises(Exception):
        read_csv(spark, path, "a int, b int").collect()
    assert sorted(r["b"] for r in read_csv(spark, path, "a int, b int", mode="PERMISSIVE").collect()) == [2, 4]


def test_inference_looks_at_every_row(spark, tmp_path):
    rows = ["i,f,s,long,t,d,flag,none,mixed,us"] + [
        f"{i},{i}.5,UK,{'w' * 31 if i == 250 else 'w'},2024-01-01T00:00:{i % 60:02d}Z,2024-01-{i % 28 + 1:02d},true,,{'x' if i == 299 else i},07/04/2023 01:02:03 PM"
        for i in range(300)
    ]
    raw = read_csv_text(spark, put(tmp_path, "wide.csv", "\n".join(rows) + "\n"))
    found = {r["column_name"]: r["column_type"] for r in infer_columns(raw).collect()}
    assert found == {
        "i": "LONG", "f": "DOUBLE", "s": "SYMBOL", "long": "STRING", "t": "TIMESTAMP", "d": "DATE",
        "flag": "BOOLEAN", "none": "STRING", "mixed": "SYMBOL", "us": "TIMESTAMP",
    }
    assert infer_schema(raw)["i"].dataType == T.LongType()
    loaded = read_csv(spark, str(tmp_path / "wide.csv"), infer_schema(raw))
    assert str(loaded.first()["us"]) == "2023-07-04 13:02:03" and loaded.where("t IS NOT NULL AND d IS NOT NULL").count() == 300


def test_a_text_column_is_a_time_only_if_one_pattern_reads_all_of_it(spark, tmp_path):
    rows = ["a,b,c", "2024-01-01T00:00:00Z,07/04/2023,2024-01-01T00:00:00Z", "n/a,2024/01/01, 2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z,07/04/2023,"]
    raw = read_csv_text(spark, put(tmp_path, "mixed.csv", "\n".join(rows) + "\n"))
    schema = infer_schema(raw)
    assert [r["column_type"] for r in infer_columns(raw).orderBy("position").collect()][:2] == ["SYMBOL", "SYMBOL"]
    assert read_csv(spark, str(tmp_path / "mixed.csv"), schema).count() == 3
    read_csv(spark, str(tmp_path / "mixed.csv"), schema).collect()


def test_wide_files_and_line_breaks(spark, tmp_path):
    path = put(tmp_path, "wide.csv", 'x,y,z\n1,"a\nb, ""c""",9\n2,d,8\n')
    for columns in (["a", "b"], ["a"], ["b"]):
        got = read_csv(spark, path, "a int, b string", multi_line=True).select(*columns).collect()
        assert got[0][-1] == (1 if columns == ["a"] else 'a\nb, "c"') and len(got) == 2


def test_a_name_given_twice_is_one_bad_line(spark):
    lines = spark.createDataFrame([("t,a=1,a=2 f=1 5",), ("t,a=1 f=1,f=2 5",), ('t,a=1 f="x",f=2 5',), ("t,a=1 f=1 5",), ("t,a=1 f=z 5",)], "value string")
    parsed = parse_lines(lines, "value")
    assert [r["malformed"] for r in parsed.collect()] == [True, True, True, False, False]
    assert count_bad(parsed, {"f": "double"}).first()[:] == (5, 3, 1)


def test_manifest_types(spark, tmp_path):
    bases = [b for spellings in WAREHOUSE_TYPES.values() for b in spellings] + ["super"]
    elements = [{"name": f"c{i}", "type": {"base": b}} for i, b in enumerate(bases)]
    path = put(tmp_path, "manifest.json", json.dumps({"entries": [], "schema": {"elements": elements}}, indent=1))
    got = [r["column_type"] for r in manifest_columns(spark, path).orderBy("position").collect()]
    assert got == [t for t, spellings in WAREHOUSE_TYPES.items() for _ in spellings] + ["STRING"]
    assert schema_of(manifest_columns(spark, path))["c0"].dataType == T.StringType()


def test_line_protocol_sample_form(spark, tmp_path):
    path = put(tmp_path, "r.txt", "readings,driver=Trish,fleet=West velocity=93 1451738990000000001\n\n")
    got = select_table(read_lines(spark, path), "readings", ["driver", "fleet", "name"], {"velocity": "double"}).first()
    assert (got["driver"], got["name"], got["velocity"], got["ts_ns"]) == ("Trish", None, 93.0, 1451738990000000001)
    assert str(got["timestamp"]) == "2016-01-02 12:49:50"


@pytest.mark.parametrize("text", ["plain", "a b", "a,b=c", 'say "hi"', "back\\slash", "end\\", "\\n", "line\nbreak", "é=ü,", "\\\\ \"", '"', "1i"])
def test_line_protocol_round_trip_of_any_text(spark, text):
    df = spark.createDataFrame([(text, text, 7, 1.5, True)], "sym string, txt string, n bigint, d double, b boolean")
    lines = to_lines(df, "my table,x", ["sym"], ["txt", "n", "d", "b"])
    assert "\n" not in lines.first()["value"]
    back = select_table(parse_lines(lines, "value"), "my table,x", ["sym"], {"txt": "string", "n": "bigint", "d": "double", "b": "boolean"})
    row = back.first()
    assert (row["sym"], row["txt"], row["n"], row["d"], row["b"], row["ts_ns"]) == (text, text, 7, 1.5, True, None)


def test_line_protocol_leaves_out_nulls(spark):
    df = spark.createDataFrame([(None, None, 5), ("s", 1.0, 6)], "s string, f double, ns bigint")
    assert [r["value"] for r in to_lines(df, "t", ["s"], ["f"], "ns").collect()] == ["t 5", "t,s=s f=1.0 6"]
    parsed = parse_lines(to_lines(df, "t", ["s"], ["f"], "ns"), "value").collect()
    assert [(r["table"], r["fields"], r["ts_ns"]) for r in parsed] == [("t", {}, 5), ("t", {"f": "1.0"}, 6)]


def test_line_protocol_marks_malformed_lines_and_handles_long_strings(spark):
    long = "x\\\" y" * 20_000
    lines = spark.createDataFrame([("a b c d",), (f't f="{long}" 1',), ("",)], "value string")
    got = parse_lines(lines, "value").collect()
    assert [r["malformed"] for r in got] == [True, False, True]
    assert got[1]["fields"]["f"] == f'"{long}"'


def test_predictions(spark, tmp_path):
    record = {"vehicleId": "V1", "stationName": "King's Cross", "timestamp": "2024-05-01T10:00:00.5Z", "expectedArrival": "soon", "timeToStation": 60, "modeName": "bus"}
    rows = read_predictions(spark, put(tmp_path, "p.json", json.dumps([record, record])))
    row = rows.first()
    assert row["stationName"] == "King_s_Cross" and row["towards"] is None and row["expectedArrival"] is None
    assert row["ts_ns"] == 1714557600500000000
    line = to_lines(rows, "predictions", SYMBOL_ORDER, ["timeToStation"], "ts_ns").first()["value"]
    assert line == "predictions,vehicleId=V1,stationName=King_s_Cross,modeName=bus timeToStation=60i 1714557600500000000"


def test_exports_keep_rows_order_and_nulls(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, " x, \"y\" ").alias("s"))
    path = scratch_path(spark, "csv")
    export_csv(df, path, order=["id"], page_rows=100)
    back = read_csv(spark, path, df.schema)
    assert back.exceptAll(df).count() == 0 and back.count() == 1000
    files = sorted({r["f"] for r in back.select(F.input_file_name().alias("f")).collect()})
    firsts = [r["n"] for r in back.groupBy(F.input_file_name().alias("f")).agg(F.min("id").alias("n"), F.count("*").alias("c")).orderBy("f").collect()]
    assert len(files) >= 10 and firsts == sorted(firsts)
    path = scratch_path(spark, "json")
    export_json(df.limit(2), path)
    assert spark.read.text(path).where(F.col("value").contains("null")).count() == 1
    assert df.orderBy("id").select(json_row(df).alias("j")).take(2)[1]["j"] == '{"id":1,"s":null}'


def test_observed_write_counts_rows(spark):
    seen = write_observed(spark.range(123), scratch_path(spark, "o"))
    assert seen["rows"] == 123 and seen["seconds"] > 0


def test_flatten_dataset(spark):
    df = spark.createDataFrame([('{"dataset": [["a", "b"], ["c"]]}',)], "r string")
    assert df.select(flatten_dataset(F.col("r")).alias("x")).first()["x"] == ["a", "b", "c"]

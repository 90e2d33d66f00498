"""Good, broken, partial and empty documents in one folder."""

import json

from pyspark.sql import functions as F

from wattloom.operators import forecasts
from wattloom.sources import documents, store
from wattloom.sources.readings import WEATHER_METRICS


def write(folder, docs):
    for name, doc in docs.items():
        (folder / f"{name}.json").write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=1))


def by_file(df, *columns):
    return {r.file.rsplit("/", 1)[-1][:-5]: tuple(r[c] for c in columns) for r in df.collect()}


def test_pv(spark, tmp_path):
    at = "2026-07-01 12:00:00"
    write(tmp_path, {
        "good": {"result": {"watts": {at: 5, "2026-07-01 13:00:00": "7.5"}, "watt_hours_period": {at: 1.0}, "watt_hours_day": {"2026-07-01": 9000}}, "message": {"x": [1]}},
        "partial": {"result": {"watts": {at: 5}}}, "empty": {"result": {"watts": [], "watt_hours_period": None, "watt_hours_day": {}}}, "bare": {"result": {}},
        "cut": '{"result": {"watts": {"2026', "text": "Internal error", "nothing": " ", "list": [1, 2], "no_result": {"message": "limit"}, "result_list": {"result": []}, "result_null": {"result": None},
        "watts_list": {"result": {"watts": [1]}}, "watts_number": {"result": {"watts": 3}}, "word": {"result": {"watts": {at: "high"}}}, "null_value": {"result": {"watts": {at: None}}},
        "key": {"result": {"watts": {"noon": 1}}}, "period": {"result": {"watts": {at: 1}, "watt_hours_period": {at: "x"}}},
    })
    good, rejects = documents.pv(spark, str(tmp_path))
    assert by_file(good, *documents.PV_MAPS) == {
        "good": ({at: 5.0, "2026-07-01 13:00:00": 7.5}, {at: 1.0}, {"2026-07-01": 9000.0}), "partial": ({at: 5.0}, {}, {}), "empty": ({}, {}, {}), "bare": ({}, {}, {}),
    }
    assert by_file(rejects, "reason") == {
        "cut": ("malformed",), "text": ("malformed",), "nothing": ("malformed",), "list": ("malformed",), "no_result": ("missing result",), "result_list": ("not a map: result",), "result_null": ("not a map: result",),
        "watts_list": ("not a map: watts",), "watts_number": ("not a map: watts",), "word": ("value: watts",), "null_value": ("value: watts",), "key": ("time: watts",), "period": ("value: watt_hours_period",),
    }
    assert forecasts.map_rows(good, "watts", "Europe/Berlin").count() == 3
    assert by_file(rejects, "text")["text"] == ("Internal error",)


def test_weather(spark, tmp_path):
    fields, time = list(WEATHER_METRICS), ["2026-01-01T00:00", "2026-01-01T01:00"]
    fine = {"time": time} | {f: [1.5, None] for f in fields}
    change = lambda **x: {"hourly": {k: v for k, v in (fine | x).items() if v != "gone"}}
    write(tmp_path, {
        "good": change(), "strings": change(**{fields[0]: ["2", "3.5"]}), "no_hours": {"hourly": {"time": []} | {f: [] for f in fields}},
        "no_hourly": {"a": 1}, "hourly_list": {"hourly": [1]}, "no_time": change(time="gone"), "no_metric": change(**{fields[2]: "gone"}), "null_metric": change(**{fields[1]: None}), "short": change(**{fields[4]: [1]}),
        "word": change(**{fields[3]: [1, "wet"]}), "when": change(time=["soon", time[1]]), "broken": "{hourly",
    })
    good, rejects = documents.weather(spark, str(tmp_path))
    assert by_file(good, "time", fields[0]) == {"good": (time, [1.5, None]), "strings": (time, [2.0, 3.5]), "no_hours": ([], [])}
    assert by_file(rejects, "reason") == {
        "no_hourly": ("missing hourly",), "hourly_list": ("not a map: hourly",), "no_time": ("missing time",), "no_metric": (f"missing {fields[2]}",), "null_metric": (f"not a list: {fields[1]}",), "short": (f"length: {fields[4]}",),
        "word": (f"value: {fields[3]}",), "when": ("time: time",), "broken": ("malformed",),
    }
    rows = forecasts.array_rows(good, "time", WEATHER_METRICS, ["file"])
    assert rows.where(F.col("file").contains("good")).count() == len(fields)


def test_an_empty_document_changes_nothing(spark, tmp_path):
    write(tmp_path, {"empty": {"result": {"watts": []}}, "broken": "no"})
    good, rejects = documents.pv(spark, str(tmp_path))
    rows = forecasts.map_rows(good, "watts", "UTC").select("forecast_for", F.lit("pv").alias("source"), F.lit("watts").alias("metric"), F.lit("doc").alias("model"), F.col("value").alias("forecast_value"))
    old = spark.sql("SELECT TIMESTAMP'2026-01-01 00:00:00' AS forecast_for, 'pv' AS source, 'watts' AS metric, 'doc' AS model, 1.0D AS forecast_value")
    assert good.count() == rejects.count() == 1 and rows.count() == 0
    assert store.upsert(old, rows, store.FORECAST_KEY).collect() == old.collect()
    path = str(tmp_path / "table")
    store.save(old, path, "forecast_for")
    store.save(store.upsert(store.load(spark, path), rows, store.FORECAST_KEY).limit(0), path, "forecast_for")
    assert store.load(spark, path).select(old.columns).collect() == old.collect()

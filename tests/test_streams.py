"""Streams over growing log folders: windows, late events, alerts."""

import datetime as dt
import json

from deliverylens.operators.monitor import MonitorLimits
from deliverylens.streaming import metrics as sm

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def write_log(path, name, entries):
    path.mkdir(exist_ok=True)
    lines = [json.dumps({**e, "timestamp": (START + dt.timedelta(minutes=m)).isoformat()}) for m, e in entries]
    (path / name).write_text("\n".join([*lines, "not-json", ""]) + "\n")


def request(latency, code=200):
    return {"event": "api_request", "path": "/predict", "status_code": code, "latency_ms": latency}


def run(spark, log, out, state):
    windows = sm.windowed_requests(sm.read_log_stream(spark, str(log)), "10 minutes", "5 minutes")
    sm.start_windows(windows, str(out), str(state)).awaitTermination()
    rows = spark.read.schema(windows.schema).parquet(str(out)).orderBy("window_start").collect()
    return {int((r["window_start"] - START.replace(tzinfo=None)).total_seconds() // 60): r for r in rows}


def test_windows_and_late_events(spark, tmp_path):
    log, out, state = tmp_path / "log", tmp_path / "out", tmp_path / "state"
    write_log(log, "a.jsonl", [(1, request(100)), (2, request(300, 500)), (12, request(50)), (40, request(10))])
    first = run(spark, log, out, state)
    assert sorted(first) == [0, 10]
    assert (first[0]["request_count"], first[0]["error_count"], first[0]["average_latency_ms"]) == (2, 1, 200.0)
    assert first[0]["p95_latency_ms"] == 290.0
    # Older than the watermark of minute 35: dropped, the closed window stays as it is.
    write_log(log, "b.jsonl", [(3, request(999)), (90, request(20))])
    second = run(spark, log, out, state)
    assert sorted(second) == [0, 10, 40]
    assert second[0]["request_count"] == 2


def test_open_windows_are_published_and_other_lines_set_aside(spark, tmp_path):
    log, out, aside = tmp_path / "log", tmp_path / "out", tmp_path / "aside"
    write_log(log, "a.jsonl", [(1, request(100)), (12, request(50))])
    (log / "c.jsonl").write_text(json.dumps(request(1)) + "\n")

    def publish():
        windows = sm.windowed_requests(sm.read_log_stream(spark, str(log)), "10 minutes", "5 minutes")
        sm.publish_windows(windows, str(out), str(tmp_path / "state")).awaitTermination()
        return [r["request_count"] for r in sm.published(spark, str(out)).orderBy("window_start").collect()]

    assert publish() == [1, 1]
    write_log(log, "b.jsonl", [(13, request(70))])
    assert publish() == [1, 2]
    lines = sm.set_aside(spark.readStream.text(str(log)))
    sm.start_windows(lines, str(aside), str(tmp_path / "aside-state")).awaitTermination()
    assert sorted(r["reason"] for r in spark.read.parquet(str(aside)).collect()) == ["no object", "no object", "no timestamp"]


def test_alerts_are_delivered(spark, tmp_path):
    log = tmp_path / "log"
    write_log(log, "a.jsonl", [(1, request(900)), (12, request(10)), (60, request(10))])
    windows = sm.windowed_requests(sm.read_log_stream(spark, str(log)), "10 minutes", "5 minutes")
    seen = []
    sm.start_alerts(
        windows, sm.request_alerts, lambda rows, _: seen.extend(rows.collect()), str(tmp_path / "state")
    ).awaitTermination()
    assert [r["alerts"] for r in seen] == [["high_average_latency"]]


def test_drift_alert_on_predictions(spark, tmp_path):
    log = tmp_path / "log"
    late = {"event": "prediction", "output": {"late_probability": 0.9, "predicted_is_late": 1}}
    write_log(log, "a.jsonl", [(1, late), (2, late), (60, late)])
    windows = sm.windowed_predictions(sm.read_log_stream(spark, str(log)), "10 minutes", "5 minutes")
    seen = []
    sm.start_alerts(
        windows,
        lambda w: sm.drift_alerts(w, MonitorLimits(minimum_predictions=2)),
        lambda rows, _: seen.extend(rows.collect()),
        str(tmp_path / "state"),
    ).awaitTermination()
    assert [r["prediction_count"] for r in seen] == [2]

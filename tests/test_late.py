"""Late-row split: every bronze row is accounted for, whatever is run again."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from punctua.operators.quality import Expectation
from punctua.operators.standardize import StandardizeSpec
from punctua.streaming.late import apply_split, read_output, run_split_stream
from punctua.streaming.silver import SilverTable

TABLE = SilverTable("series", StandardizeSpec(dates={"day": "yyyy-MM-dd"}, casts={"value": "double"}), ["code", "day"],
                    [Expectation("has_code", "code IS NOT NULL", "drop"), Expectation("positive", "value IS NULL OR value >= 0", "warn")],
                    event_time="day", watermark="10 days")
D0 = dt.date(2024, 3, 1)


def batch(spark, rows, k):
    text = [(c, None if d is None else str(D0 + dt.timedelta(days=d)), v, f"f{k}", dt.datetime(2024, 4, 1)) for c, d, v in rows]
    return spark.createDataFrame(text, "code string, day string, value string, _source_file string, _ingested_at timestamp")


BATCHES = [
    [("a", 0, "1"), ("a", 0, "1"), ("b", 5, "2"), (None, 5, "3"), ("c", None, "4"), ("c", None, "4")],
    [("a", 20, "1"), ("a", 0, "7"), ("b", -5, "1"), ("c", None, "4"), (None, 5, "3")],
    [("a", 10, "late at the mark"), ("a", 11, "2"), ("a", 20, "again"), ("b", 9, "2"), (None, None, None)],
]
#: by batch: late, duplicates, valid, quarantine
FLOW = [(0, 2, 2, 2), (1, 2, 1, 1), (2, 1, 1, 1)]


def state(spark, out):
    rows = lambda name: Counter((r["batch"], r["code"], r["day"]) for r in read_output(spark, out, name).collect())
    flow = {r["batch"]: (r["late"], r["duplicates"], r["valid"], r["quarantine"]) for r in read_output(spark, out, "series_flow").collect()}
    return rows("series"), rows("series_quarantine"), rows("series_late"), flow


def test_batches_and_retries(spark, tmp):
    for k, rows in enumerate(BATCHES):
        apply_split(spark, batch(spark, rows, k), k, TABLE, f"{tmp}/out")
    want = state(spark, f"{tmp}/out")
    assert want[3] == {str(k): f for k, f in enumerate(FLOW)}
    assert all(sum(f) == len(rows) for f, rows in zip(FLOW, BATCHES))
    assert want[2] == Counter({("1", "b", D0 - dt.timedelta(days=5)): 1, ("2", "a", D0 + dt.timedelta(days=10)): 1,
                               ("2", "b", D0 + dt.timedelta(days=9)): 1})
    for again in (2, 2):  # a retry sees the outputs of its first attempt and must not take them for earlier ones
        apply_split(spark, batch(spark, BATCHES[again], again), again, TABLE, f"{tmp}/out")
        assert state(spark, f"{tmp}/out") == want


def test_rules_and_reasons(spark, tmp):
    apply_split(spark, batch(spark, [(None, None, "1"), ("a", None, "-1"), (None, 3, "1"), ("a", 3, "-1")], 0), 0, TABLE, f"{tmp}/out")
    bad = {(r["code"], r["day"]): r["_failed_rules"] for r in read_output(spark, f"{tmp}/out", "series_quarantine").collect()}
    assert bad == {(None, None): ["has_code", "event_time_known"], ("a", None): ["event_time_known"],
                   (None, D0 + dt.timedelta(days=3)): ["has_code"]}


def test_stream_over_several_runs(spark, tmp):
    """A restart goes on under the watermark that earlier runs have seen."""
    for k, rows in enumerate(BATCHES):
        batch(spark, rows, k).coalesce(1).write.mode("append").parquet(f"{tmp}/bronze")
        run_split_stream(spark, f"{tmp}/bronze", TABLE, f"{tmp}/out", f"{tmp}/checkpoint", max_files_per_trigger=1)
    flow = [tuple(r) for r in read_output(spark, f"{tmp}/out", "series_flow").orderBy("batch").select(
        "late", "duplicates", "valid", "quarantine").collect()]
    assert flow == FLOW
    total = sum(read_output(spark, f"{tmp}/out", "series_flow").select(F.sum("rows")).first())
    assert total == sum(map(len, BATCHES))

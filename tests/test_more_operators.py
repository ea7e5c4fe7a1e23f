"""Current state, zone changes, shared trailing sums, held series, contracts, two-dimension layout, models as expressions."""

import datetime as dt
import glob
import math
import random
from zoneinfo import ZoneInfo

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.functions.zones import instants, resolve_folds, zone_changes
from punctua.operators.contract import conformed, contract_report
from punctua.operators.layout import interleaved, quantile_place, write_interleaved
from punctua.operators.linear import linear_score, newton_logistic, permutation_importance, permuted
from punctua.operators.quality import Expectation, guarded
from punctua.operators.scd2 import current_view, scd2_current_state, scd2_from_cdc
from punctua.operators.timeseries import forward_fill, held_values, trailing_grains

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("seed", range(4))
def test_current_state_is_the_open_part_of_the_history(spark, seed):
    rnd = random.Random(seed)
    ev = [(rnd.choice([None, 1, 2, 3, 4, 5]), rnd.randrange(60), T0 + dt.timedelta(minutes=rnd.randrange(99)), rnd.choice("AB"),
           rnd.choice(["x", None]), rnd.random() < 0.2) for _ in range(150)]
    df = spark.createDataFrame(ev, "k int, n int, t timestamp, a string, b string, gone boolean")
    args = ("k", "n", "t", ["a", "b"], F.col("gone"))
    want = current_view(scd2_from_cdc(df, *args))
    got = scd2_current_state(df, *args)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


ZONES = ["America/Sao_Paulo", "America/New_York", "Europe/Lisbon", "Australia/Lord_Howe", "Asia/Tokyo", "America/Santiago"]


def brute_instants(local, zone):
    """(first, second, repeated, gap) by trying every offset that the zone has around the time."""
    z = ZoneInfo(zone)
    utc = lambda t: t.replace(tzinfo=None)
    offsets = {(local + dt.timedelta(hours=h)).replace(tzinfo=dt.timezone.utc).astimezone(z).utcoffset() for h in range(-36, 37, 1)}
    found = sorted(local - o for o in offsets if utc((local - o).replace(tzinfo=dt.timezone.utc).astimezone(z)) == local)
    if found:
        return found[0], found[-1], len(found) > 1, False
    before = (local - dt.timedelta(hours=30)).replace(tzinfo=dt.timezone.utc).astimezone(z).utcoffset()
    return local - before, local - before, False, True


def test_instants_against_zone_rules(spark):
    days = [dt.datetime(2017, 10, 14, 22), dt.datetime(2018, 2, 17, 21), dt.datetime(2018, 11, 3, 21), dt.datetime(2019, 2, 16, 22),
            dt.datetime(2018, 3, 10, 23), dt.datetime(2018, 3, 25, 0), dt.datetime(2018, 10, 28, 0), dt.datetime(2018, 4, 1, 0),
            dt.datetime(2018, 10, 7, 0), dt.datetime(2018, 8, 11, 21), dt.datetime(2018, 5, 12, 21), dt.datetime(2019, 12, 30, 0)]
    rows = [(z, d + dt.timedelta(minutes=15 * i)) for z in ZONES for d in days for i in range(28)]
    df = spark.createDataFrame(rows, "zone string, local timestamp_ntz")
    changes = zone_changes(df, "zone", "2017-01-01", "2020-01-01")
    j = df.join(F.broadcast(changes), F.col("zone") == F.col("z_zone"))
    local = F.col("local").cast("timestamp")
    got = {(r["zone"], r["local"]): (r["a"], r["b"], r["f"], r["g"]) for r in j.withColumn("at", instants(
        local, F.col("z_first"), F.col("z_changes"))).select("zone", "local", F.col("at.first_utc").cast("timestamp_ntz").alias("a"),
        F.col("at.second_utc").cast("timestamp_ntz").alias("b"), F.col("at.is_repeated").alias("f"), F.col("at.is_gap").alias("g")).collect()}
    want = {(z, t): brute_instants(t, z) for z, t in rows}
    assert got == want
    assert sum(w[2] for w in want.values()) > 20 and sum(w[3] for w in want.values()) > 20


def test_folds_by_order(spark):
    """Readings every 20 minutes through the night in which the clock goes back, in the order they were taken."""
    z, start = "America/Sao_Paulo", dt.datetime(2018, 2, 18, 0, 30)  # in UTC; back at 02:00 UTC
    true = [start + dt.timedelta(minutes=20 * i) for i in range(12)]
    local = [t.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(z)).replace(tzinfo=None) for t in true]
    rows = [("a", i, z, t) for i, t in enumerate(local)] + [("b", 0, z, local[3]), ("c", 0, "nowhere", local[0]), ("d", 0, z, None)]
    df = spark.createDataFrame(rows, "k string, n int, zone string, local timestamp_ntz").withColumn("local", F.col("local").cast("timestamp"))
    changes = zone_changes(df.where("zone != 'nowhere'"), "zone", "2017-01-01", "2020-01-01")
    out = resolve_folds(df, "k", "local", "n", "zone", changes).withColumn("utc_ts", F.col("utc_ts").cast("timestamp_ntz"))
    got = {(r["k"], r["n"]): (r["utc_ts"], r["is_repeated"]) for r in out.collect()}
    assert [got["a", i][0] for i in range(12)] == true
    assert sum(got["a", i][1] for i in range(12)) == 6
    assert got["b", 0][0] == true[3] and got["c", 0] == (None, False) and got["d", 0] == (None, False)


@pytest.mark.parametrize("bucket", [None, 0.3])
def test_trailing_grains_brute_force(spark, bucket):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([1, 2, 3]), T0 + dt.timedelta(hours=rnd.randrange(200)),
             None if rnd.random() < 0.1 else T0 + dt.timedelta(hours=rnd.randrange(200)), rnd.choice([0, 1, None])) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, x string, y int, at timestamp, known timestamp, late int")
    grains = {"xy": ["x", "y"], "x": ["x"], "y": ["y"]}
    out = trailing_grains(df, df, grains, "at", "known", {"n": F.lit(1), "late": F.col("late")}, 2.0, bucket).collect()
    assert len(out) == len(rows)
    for r in out:
        for g, keys in grains.items():
            mine = [r[k] for k in keys]
            near = [q for q in rows if q[4] is not None and None not in mine and [q[{"x": 1, "y": 2}[k]] for k in keys] == mine
                    and r["at"] - dt.timedelta(days=2) <= q[4] < r["at"]]
            assert (r[f"{g}_n"], r[f"{g}_late"]) == (len(near), sum(q[5] or 0 for q in near))


def test_held_values(spark):
    d = lambda n: dt.date(2024, 1, n)
    df = spark.createDataFrame([("a", d(2), 1.0), ("a", d(5), None), ("a", d(7), 2.0), ("b", d(9), 3.0), ("c", d(20), 4.0), (None, d(1), 5.0)],
                               "k string, day date, v double")
    got = sorted((r["k"], r["day"].day, r["v"]) for r in held_values(df, "k", "day", "v", "2024-01-10").collect())
    assert got == [("a", n, 1.0) for n in range(2, 7)] + [("a", n, 2.0) for n in range(7, 11)] + [("b", 9, 3.0), ("b", 10, 3.0)]


CONTRACT = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("v", T.DoubleType()), T.StructField("gone", T.StringType())])


def test_contract_report_and_conformed(spark):
    df = spark.createDataFrame([(1, "1.5", "x"), (None, "2", "x"), (3, "a", "x"), (4, None, "x")], "id long, v string, more string")
    got = {(r["column"], r["problem"]): (r["expected"], r["actual"], r["bad_rows"]) for r in contract_report(df, CONTRACT).collect()}
    assert got == {("id", "null"): ("not null", "nullable", 1), ("v", "type"): ("double", "string", 1),
                   ("gone", "missing"): ("string", None, 4), ("more", "extra"): (None, "string", 0)}
    have = T.StructType(CONTRACT.fields[:2])
    out = conformed(df, have)
    assert out.dtypes == [("id", "bigint"), ("v", "double")] and sorted(map(tuple, out.collect())) == [(1, 1.5), (4, None)]
    assert conformed(df, CONTRACT).count() == 0
    with pytest.raises(PySparkException, match="type v"):
        conformed(df.where("id = 3"), have, fail=True).collect()
    assert conformed(df.where("id = 1"), have, fail=True).count() == 1
    assert contract_report(df.limit(0), CONTRACT).agg(F.sum("bad_rows")).first()[0] == 0


def test_fail_rule_inside_the_plan(spark, tmp):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    rules = [Expectation("has_n", "n IS NOT NULL", "fail"), Expectation("small", "n < 2", "warn")]
    with pytest.raises(PySparkException, match="has_n"):
        guarded(df, rules).write.parquet(f"{tmp}/out")
    assert guarded(df.where("n > 0"), rules).count() == 2
    assert guarded(df, rules[1:]).count() == 3


def test_places_and_interleaving(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    splits = [10.0, 20.0, 20.5, 90.0]
    got = [r["p"] for r in df.select(quantile_place(F.col("x"), splits).alias("p")).collect()]
    assert got == [sum(s <= x for s in splits) for x in range(100)]
    pairs = [(a, b) for a in range(8) for b in range(8)]
    z = {(r["a"], r["b"]): r["z"] for r in spark.createDataFrame(pairs, "a int, b int").select(
        "a", "b", interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect()}
    assert z == {(a, b): int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}")), 2) for a, b in pairs}


def test_filters_on_either_dimension_skip_row_groups(spark, tmp):
    """A third of the rows share one value of the first dimension."""
    rnd = random.Random(1)
    rows = [(i, 5.0 if i % 3 == 0 else rnd.random() * 100, rnd.expovariate(0.01), i % 7) for i in range(20_000)]
    df = spark.createDataFrame(rows, "i int, x double, y double, z int")
    write_interleaved(df, f"{tmp}/t", [F.col("x"), F.col("y")], files=32)
    assert spark.read.parquet(f"{tmp}/t").count() == 20_000
    groups = []
    for f in glob.glob(f"{tmp}/t/*.parquet"):
        m = pq.ParquetFile(f).metadata
        names = [m.schema.column(k).name for k in range(m.num_columns)]
        for g in range(m.num_row_groups):
            stats = {n: m.row_group(g).column(k).statistics for k, n in enumerate(names)}
            groups.append({n: (s.min, s.max) for n, s in stats.items()})
    assert len(groups) >= 24
    for c, values in (("x", [rnd.uniform(10, 99) for _ in range(50)]), ("y", [rnd.expovariate(0.01) for _ in range(50)])):
        read = [sum(g[c][0] <= v <= g[c][1] for g in groups) for v in values]
        assert np.mean(read) < len(groups) / 2


def test_newton_fit_is_the_maximum(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.gauss(0, 1), rnd.choice([0.0, 1.0, None])) for i in range(3000)]
    rows = [(i, x, y, int(rnd.random() < 1 / (1 + math.exp(-(0.5 - 1.2 * x + 0.7 * (y or 0)))))) for i, x, y in rows] + [(-1, 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "i int, x double, y double, label int").cache()
    w = newton_logistic(df, ["x", "y"], "label", 8)
    data = np.array([(1.0, x, y or 0.0) for _, x, y, t in rows if t is not None])
    label = np.array([t for *_, t in rows if t is not None])
    gradient = data.T @ (label - 1 / (1 + np.exp(-data @ np.array(w))))
    assert np.abs(gradient).max() < 1e-3
    assert abs(w[1] + 1.2) < 0.3
    got = {r["i"]: r["p"] for r in df.select("i", linear_score(w, ["x", "y"]).alias("p")).collect()}
    assert all(abs(got[i] - 1 / (1 + math.exp(-(w[0] + w[1] * x + w[2] * (y or 0))))) < 1e-12 for i, x, y, _ in rows)
    # x decides most, y some, and a feature that the formula leaves out nothing
    imp = {r["feature"]: r["importance"] for r in permutation_importance(
        df, lambda: linear_score([*w, 0.0], ["x", "y", "i"]), ["x", "y", "i"], "label", ["i"]).collect()}
    assert imp["x"] > imp["y"] > abs(imp["i"]) < 1e-12


@pytest.mark.parametrize("n,digits", [(1, 1), (2, 2), (400, 1), (400, 2)])
def test_permutation_is_one(spark, n, digits):
    rows = [(i, None if i % 10 == 3 else i) for i in range(n)]
    df = spark.createDataFrame(rows, "i int, x int")
    once, again = ({r["i"]: r["x"] for r in permuted(df.repartition(k), "x", ["i"], digits).collect()} for k in (2, 5))
    assert once == again and set(once) == set(range(n))
    assert sorted(once.values(), key=str) == sorted((x for _, x in rows), key=str)
    assert n < 100 or sum(once[i] == x for i, x in rows if x is not None) < n / 10


def test_forward_fill_with_and_without_given_bounds(spark):
    """Both ways of filling agree: from the rows themselves, and over a calendar that is given."""
    rnd = random.Random(12)
    days = sorted({(rnd.choice("abcd"), rnd.randrange(40)) for _ in range(60)})
    rows = [(k, dt.date(2024, 2, 1) + dt.timedelta(days=n), None if rnd.random() < 0.2 else rnd.random()) for k, n in days]
    df = spark.createDataFrame(rows, "k string, day date, v double")
    lo, hi = min(r[1] for r in rows), max(r[1] for r in rows)
    one, two = (sorted(map(tuple, forward_fill(df, "k", "day", "v", *bounds).collect()), key=str) for bounds in ((), (lo, hi)))
    assert one == two and len(one) == 4 * ((hi - lo).days + 1)
    assert forward_fill(df.limit(0), "k", "day", "v").count() == 0

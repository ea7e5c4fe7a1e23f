"""Model training/scoring on the leak-free feature table, and CDC streaming
into type-2 history (stream result equals the batch result)."""

import datetime as dt
import os
import random
import shutil

from pyspark.sql import functions as F

from conftest import SF_SMALL, write  # noqa: F401
from punctua.operators.ml import (feature_importances, fit_prep, ml_session, score, train_gbt, train_logistic, with_class_weights,
                                  write_scores)
from punctua.operators.scd2 import scd2_from_cdc
from punctua.operators.stats import pr_curve
from punctua.operators.timeseries import trailing_grains
from punctua.plans.ml_q import features, split_of
from punctua.streaming.cdc import apply_batch, read_history, run_cdc_stream
from punctua.tables import Tables

FEATURES = ["route_n_30d", "route_rate_30d", "prev_rain_mm", "iso_weekday", "month"]


def test_train_score_and_importances(spark, tmp):
    f = features(Tables(spark, SF_SMALL)).withColumn("split", split_of(F.col("planned_ts"))).cache()
    train = with_class_weights(f.filter(F.col("split") == "train"), "label")
    test = f.filter(F.col("split") == "test")
    lr = train_logistic(train, FEATURES)
    gbt = train_gbt(train, FEATURES, max_iter=5, max_depth=3)
    for m in (lr, gbt):
        s = score(m, test, FEATURES)
        vals = [r["score"] for r in s.select("score").collect()]
        assert len(vals) == test.count() and all(0.0 <= v <= 1.0 for v in vals)
        curve = pr_curve(s, "score", "label").collect()
        assert all(0.0 <= r["average_precision"] <= 1.0 for r in curve)
    imp = {r["feature"]: r["importance"] for r in feature_importances(gbt, FEATURES).collect()}
    assert set(imp) == set(FEATURES) and abs(sum(imp.values()) - 1.0) < 1e-6
    scored = score(gbt, test, FEATURES).withColumn("score_date", F.to_date("planned_ts"))
    write_scores(scored, f"{tmp}/pred")
    write_scores(scored.filter(F.col("score_date") == scored.agg(F.min("score_date")).first()[0]), f"{tmp}/pred")
    assert spark.read.parquet(f"{tmp}/pred").count() == scored.count()   # only one day was replaced
    f.unpersist()


def test_cdc_stream_equals_batch(spark, tmp):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    ev = [(rnd.randrange(4), i, base + dt.timedelta(minutes=i), rnd.choice(["A", "B", "B", "DEL"]))
          for i in range(120)]
    rnd.shuffle(ev)                                # out-of-order arrival across files
    schema = "aircraft_id int, sequence_num int, event_ts timestamp, modelo string"
    for j in range(4):
        chunk = ev[j * 30:(j + 1) * 30] + (ev[:3] if j == 3 else [])     # duplicates in the last file
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("overwrite").parquet(f"{tmp}/in/f{j}")
        stream = spark.readStream.schema(schema).parquet(f"{tmp}/in/f*")
        run_cdc_stream(spark, stream, f"{tmp}/cdc", f"{tmp}/ck", "aircraft_id", "sequence_num", "event_ts",
                       ["modelo"], lambda: F.col("modelo") == "DEL")
    hist = read_history(spark, f"{tmp}/cdc")
    batch = scd2_from_cdc(spark.createDataFrame(ev, schema), "aircraft_id", "sequence_num", "event_ts",
                          ["modelo"], F.col("modelo") == "DEL")
    cols = ["aircraft_id", "modelo", "valid_from_seq", "valid_to_seq"]
    assert sorted(tuple(r) for r in hist.select(*cols).collect()) == sorted(tuple(r) for r in batch.select(*cols).collect())


def test_cdc_stream_with_processing_time_trigger(spark, tmp):
    schema = "aircraft_id int, sequence_num int, event_ts timestamp, modelo string"
    base = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, 1, base, "A"), (1, 2, base, "B"), (2, 3, base, "A")], schema) \
        .write.parquet(f"{tmp}/in/f0")
    stream = spark.readStream.schema(schema).parquet(f"{tmp}/in/f*")
    q = run_cdc_stream(spark, stream, f"{tmp}/cdc", f"{tmp}/ck", "aircraft_id", "sequence_num", "event_ts",
                       ["modelo"], lambda: F.col("modelo") == "DEL", trigger={"processingTime": "1 second"},
                       wait=False)
    try:
        q.processAllAvailable()
        spark.createDataFrame([(2, 4, base, "DEL")], schema).write.parquet(f"{tmp}/in/f1")
        q.processAllAvailable()
    finally:
        q.stop()
    hist = sorted((r["aircraft_id"], r["modelo"], r["valid_from_seq"], r["valid_to_seq"])
                  for r in read_history(spark, f"{tmp}/cdc").collect())
    assert hist == [(1, "A", 1, 2), (1, "B", 2, None), (2, "A", 3, 4)]


CDC_SCHEMA = "k int, n int, t timestamp, v string"
T0 = dt.datetime(2024, 1, 1)


def cdc_batch(spark, root, batch_id, rows, parts=8):
    df = spark.createDataFrame([(k, n, T0 + dt.timedelta(minutes=n), v) for k, n, v in rows], CDC_SCHEMA)
    return apply_batch(spark, df, batch_id, root, "k", "n", "t", ["v"], lambda: F.col("v") == "DEL", parts=parts)


def versions(spark, root):
    h = read_history(spark, root)
    return [] if h is None else sorted((r["k"], r["v"], r["valid_from_seq"], r["valid_to_seq"]) for r in h.collect())


def files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_cdc_batch_leaves_other_partitions_alone(spark, tmp):
    rows = [(k, k, "A") for k in range(40)]
    assert cdc_batch(spark, tmp, 0, rows) == list(range(8))
    before = files(f"{tmp}/history")
    touched = cdc_batch(spark, tmp, 1, [(3, 100, "B")])
    after = files(f"{tmp}/history")
    assert len(touched) == 1
    part = f"part={touched[0]}/"
    assert {f for f in before if part not in f} == {f for f in after if part not in f}
    assert not {f for f in before if part in f} & after
    assert versions(spark, tmp) == sorted([(k, "A", k, 100 if k == 3 else None) for k in range(40)] + [(3, "B", 100, None)])


def test_cdc_retry_and_late_events(spark, tmp):
    """A batch that ran once wholly, or once without its history, gives the same result when it runs again."""
    cdc_batch(spark, tmp, 0, [(1, 1, "A"), (1, 5, "C"), (2, 2, "A"), (None, 1, "N")])
    late = [(1, 3, "B"), (2, 9, "DEL"), (1, 3, "B")]
    cdc_batch(spark, tmp, 1, late)
    want = sorted([(1, "A", 1, 3), (1, "B", 3, 5), (1, "C", 5, None), (2, "A", 2, 9)])
    rest = lambda: [v for v in versions_or_none(spark, tmp) if v[0] is not None]
    assert rest() == want
    cdc_batch(spark, tmp, 1, late)
    assert rest() == want
    for p in os.listdir(f"{tmp}/history"):
        if p.startswith("part="):
            shutil.move(f"{tmp}/history/{p}", f"{tmp}/lost-{p}")
    cdc_batch(spark, tmp, 1, late)
    assert rest() == want


def versions_or_none(spark, root):
    h = read_history(spark, root)
    return sorted(((r["k"], r["v"], r["valid_from_seq"], r["valid_to_seq"]) for r in h.collect()), key=str)


def test_cdc_partition_without_versions_goes(spark, tmp):
    cdc_batch(spark, tmp, 0, [(1, 1, "A")])
    assert versions(spark, tmp) == [(1, "A", 1, None)]
    cdc_batch(spark, tmp, 1, [(1, 1, "DEL")])  # of events that repeat key and number the smallest state counts, a delete first
    assert versions(spark, tmp) == []
    assert cdc_batch(spark, tmp, 2, []) == []


def test_grains_by_their_columns(spark):
    """Sums and rates per grain against a brute force: keys whose texts joined would be the same, two grains of the same columns,
    NULL keys and times, rows that come twice."""
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "a|b", None]), rnd.choice(["b|c", "c"]), rnd.choice([1, 2, None]),
             dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randrange(20)), rnd.choice([
                 None, dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randrange(20))]), rnd.choice([0, 1])) for i in range(60)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "i int, o string, d string, c int, t timestamp, r timestamp, y int")
    grains = {"way": ["o", "d"], "back": ["d", "o"], "line": ["c"]}
    got = trailing_grains(df, df, grains, "t", "r", {"n": F.lit(1), "late": F.col("y")}, 7, rates={"rate": ("late", "n")})
    at = {"o": 1, "d": 2, "c": 3}
    want = []
    for x in rows:
        out = [x[0]]
        for cols in grains.values():
            seen = [y[6] for y in rows if y[5] is not None and x[4] - dt.timedelta(days=7) <= y[5] < x[4]
                    and all(x[at[k]] is not None and x[at[k]] == y[at[k]] for k in cols)]
            out += [len(seen), sum(seen), round(sum(seen) / len(seen), 6) if seen else None]
        want.append(tuple(out))
    names = [f"{g}_{n}" for g in grains for n in ("n", "late", "rate")]
    assert got.columns == [*df.columns, *names]
    assert sorted(map(str, (tuple(x) for x in got.select("i", *names).collect()))) == sorted(map(str, want))


def test_training_session_keeps_settings_and_cuts_tables(spark, tmp):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "7654321")
    try:
        own = ml_session(spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert own.conf.get("spark.sql.autoBroadcastJoinThreshold") == "7654321"
    cores = spark.sparkContext.defaultParallelism
    spark.range(4000).repartition(8 * cores).write.parquet(f"{tmp}/t")
    assert own.read.parquet(f"{tmp}/t").rdd.getNumPartitions() >= 4 * cores


def test_models_share_one_preparation(spark):
    """Medians are found once for all models of the same rows, and the models are those that find their own."""
    rnd = random.Random(3)
    rows = [(x, rnd.choice([None, rnd.random()]), int(x + rnd.random() > 1)) for x in (rnd.random() for _ in range(300))]
    train = with_class_weights(spark.createDataFrame(rows, "a double, b double, label int"), "label").cache()
    prep = fit_prep(train, ["a", "b"])
    for fit in (train_logistic, lambda *a, **k: train_gbt(*a, max_iter=2, max_depth=2, **k)):
        shared, alone = fit(train, ["a", "b"], prep=prep), fit(train, ["a", "b"])
        assert [s.uid for s in shared.stages[:-1]] == [s.uid for s in prep.stages]
        a, b = ([r["score"] for r in score(m, train, ["a", "b"]).orderBy("a").select("score").collect()] for m in (shared, alone))
        assert max(abs(x - y) for x, y in zip(a, b, strict=True)) < 1e-9
    train.unpersist()

"""Delay-prediction datasets: label, leak-free features, temporal split,
PR curve and drift."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from punctua.operators.calendar import is_high_season, is_holiday, iso_weekday
from punctua.operators.linear import linear_score, newton_logistic, permutation_importance
from punctua.operators.stats import pr_curve, psi
from punctua.operators.timeseries import held_values, trailing_grains, trailing_sums
from punctua.plans.flights import FLIGHTS_SQL, valid_flights
from punctua.plans.registry import query
from punctua.plans.series_q import _PRICE_SQL, filled_price, price_at
from punctua.session import materialize
from punctua.tables import Tables

# Parameters.
LABEL_MINUTES = 15
HISTORY_DAYS = 30
SPLIT_VALIDATION_FROM = "1999-01-01"
SPLIT_TEST_FROM = "2000-06-01"


def labelled(t: Tables, flights=None):
    f = (flights if flights is not None else valid_flights(t)).filter(~F.col("cancelled"))
    return f.withColumn("label", (F.col("delay_min") > LABEL_MINUTES).cast("int"))


def flight_base(t: Tables, *more: str):
    """The validated flights, computed once and materialised with the columns that the branches of a feature
    plan (labels, outcomes, rain) read, and ``more``."""
    return materialize(valid_flights(t).select("order_key", "line_number", "origin", "destination", "planned_ts",
                                               "real_ts", "delay_min", "cancelled", *more), "flights")


_LAB_SQL = f"""
lab AS (SELECT order_key, line_number, part_key, carrier, origin, destination, planned_ts, real_ts, delay_min, quantity,
               CAST(CASE WHEN delay_min > {LABEL_MINUTES} THEN 1 ELSE 0 END AS INTEGER) AS label
        FROM f WHERE NOT cancelled AND carrier IS NOT NULL AND origin IS NOT NULL AND planned_ts IS NOT NULL)"""


@query("label_delay15", sql=f"""
WITH {FLIGHTS_SQL}, {_LAB_SQL}
SELECT order_key, line_number, round(delay_min, 6) AS delay_min, label FROM lab
""")
def q_label_delay15(spark: SparkSession, sf_dir: str):
    return labelled(Tables(spark, sf_dir)).select("order_key", "line_number",
                                                  F.round("delay_min", 6).alias("delay_min"), "label")


def route_history(lab):
    """``lab`` with, per flight, count and delay rate of the route's flights whose outcome was
    known (actual time) in the 30 days before this flight's planned time."""
    out = trailing_sums(lab, lab.filter("label IS NOT NULL").select("origin", "destination", "real_ts", "label"),
                        ["origin", "destination"], "planned_ts", "real_ts",
                        {"route_n_30d": F.lit(1), "route_late_30d": F.col("label")}, HISTORY_DAYS)
    return out.withColumn("route_rate_30d", F.when(F.col("route_n_30d") > 0,
                                                   F.col("route_late_30d") / F.col("route_n_30d")))


#: Grains of the delay history: name and key columns.
GRAINS = {"route": ["origin", "destination"], "carrier": ["carrier"], "origin": ["origin"], "destination": ["destination"]}
# Aircraft by size: largest p_size of the smaller tiers.
SMALL_UPTO, MEDIUM_UPTO = 15, 35


def features(t: Tables):
    """Leak-free features per flight, all known strictly before its planned departure.

    * flights and delay rate over the previous 30 days of the route, the carrier and both airports, counting only flights
      whose outcome (actual time) was known before this flight's planned time;
    * "rain" of the last complete day with any at both airports (a day becomes known when it ends);
    * the price of the last complete month, from its own source, gaps filled;
    * the aircraft's size tier; calendar parts and hour of the planned time.
    """
    allf = flight_base(t, "carrier", "quantity", "part_key")
    lab = labelled(t, allf).select("order_key", "line_number", "part_key", "carrier", "origin", "destination", "planned_ts",
                                   "real_ts", "label")
    base = trailing_grains(lab, lab.where("label IS NOT NULL"), GRAINS, "planned_ts", "real_ts",
                           {"n_30d": F.lit(1), "late_30d": F.col("label")}, HISTORY_DAYS, rates={"rate_30d": ("late_30d", "n_30d")})
    # what is known just before the planned time: days that ended by then, on the day of the instant before
    eve = F.to_date(F.timestamp_micros(F.unix_micros("planned_ts") - 1))
    last = lab.agg(F.max(eve)).first()[0]
    rain = (allf.groupBy(F.col("destination").alias("airport"), F.date_add(F.to_date("real_ts"), 1).alias("known_day"))
            .agg(F.sum("quantity").alias("rain_mm")))
    rain = held_values(rain, "airport", "known_day", "rain_mm", last).withColumn("rain_mm", F.round("rain_mm", 6))
    rain = materialize(rain, "rain-known")  # airports x days
    for side in ("origin", "destination"):
        known = rain.select(*[F.col(c).alias(f"{side}_{c}") for c in rain.columns])
        base = base.join(known, (F.col(side) == F.col(f"{side}_airport")) & (eve == F.col(f"{side}_known_day")), "left")
    prices, month = price_at(filled_price(t), F.col("planned_ts"))
    base = base.join(prices.withColumn("price", F.round("price", 6)), month == F.col("p_month"), "left")
    size = t.part.select("p_partkey", "p_size")
    base = base.join(size, F.col("part_key") == F.col("p_partkey"), "left")
    tier = (F.when(F.col("p_size") <= SMALL_UPTO, "small").when(F.col("p_size") <= MEDIUM_UPTO, "medium")
            .when(F.col("p_size").isNotNull(), "large"))
    d = F.col("planned_ts")
    history = [c for g in GRAINS for c in (f"{g}_n_30d", f"{g}_rate_30d")]
    return base.select("order_key", "line_number", "carrier", "origin", "destination", "planned_ts", "label", *history,
                       F.col("origin_rain_mm").alias("prev_rain_origin_mm"), F.col("destination_rain_mm").alias("prev_rain_mm"),
                       "price", tier.alias("aircraft_tier"), F.hour(d).alias("hour"),
                       iso_weekday(d).alias("iso_weekday"), F.month(d).alias("month"),
                       is_holiday(d).alias("is_holiday"), is_high_season(d).alias("is_high_season"))


def _history_sql(grain: str, keys: list[str]) -> str:
    by = ", ".join(keys)
    return f"""
u_{grain} AS (SELECT order_key, line_number, {by}, planned_ts AS t, CAST(NULL AS INTEGER) AS outcome FROM lab
              UNION ALL SELECT NULL, NULL, {by}, real_ts, label FROM lab),
tr_{grain} AS (SELECT order_key, line_number, count(outcome) OVER w AS {grain}_n_30d, avg(outcome) OVER w AS {grain}_rate_30d
               FROM u_{grain} WINDOW w AS (PARTITION BY {by} ORDER BY t
                 RANGE BETWEEN INTERVAL {HISTORY_DAYS} DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING))"""


@query("feature_table", sql=f"""
WITH {FLIGHTS_SQL}, {_LAB_SQL},{",".join(_history_sql(g, k) for g, k in GRAINS.items())}, {_PRICE_SQL},
known AS (SELECT CAST(month + INTERVAL 1 MONTH AS TIMESTAMP) AS p_ts, price FROM pf),
rain AS (SELECT destination AS airport, CAST(CAST(real_ts AS DATE) + 1 AS TIMESTAMP) AS known_ts, sum(quantity) AS rain_mm
         FROM f WHERE carrier IS NOT NULL AND origin IS NOT NULL AND planned_ts IS NOT NULL GROUP BY 1, 2),
wd AS (SELECT lab.*, rain.rain_mm AS rain_d FROM lab ASOF LEFT JOIN rain
       ON lab.destination = rain.airport AND lab.planned_ts > rain.known_ts),
wo AS (SELECT wd.*, rain.rain_mm AS rain_o FROM wd ASOF LEFT JOIN rain ON wd.origin = rain.airport AND wd.planned_ts > rain.known_ts),
-- the price of a month is known from the first day of the next one; beyond the series' last known month there is none
wp AS (SELECT wo.*, CASE WHEN wo.planned_ts <= (SELECT max(p_ts) FROM known) + INTERVAL 1 MONTH THEN known.price END AS price
       FROM wo ASOF LEFT JOIN known ON wo.planned_ts > known.p_ts)
SELECT wp.order_key, wp.line_number, carrier, origin, destination, planned_ts, label,
       {", ".join(f"{g}_n_30d, round({g}_rate_30d, 6) AS {g}_rate_30d" for g in GRAINS)},
       round(rain_o, 6) AS prev_rain_origin_mm, round(rain_d, 6) AS prev_rain_mm, round(price, 6) AS price,
       CASE WHEN p_size <= {SMALL_UPTO} THEN 'small' WHEN p_size <= {MEDIUM_UPTO} THEN 'medium' WHEN p_size IS NOT NULL THEN 'large' END
         AS aircraft_tier,
       CAST(hour(planned_ts) AS INTEGER) AS hour,
       CAST(isodow(planned_ts) AS INTEGER) AS iso_weekday, CAST(month(planned_ts) AS INTEGER) AS month,
       (month(planned_ts) * 100 + day(planned_ts)) IN (101, 421, 501, 907, 1012, 1102, 1115, 1225) AS is_holiday,
       month(planned_ts) IN (1, 7, 12) AS is_high_season
FROM wp {" ".join(f"JOIN (SELECT * FROM tr_{g} WHERE order_key IS NOT NULL) t_{g} ON wp.order_key = t_{g}.order_key AND wp.line_number = t_{g}.line_number" for g in GRAINS)}
LEFT JOIN part ON part_key = p_partkey
""")
def q_feature_table(spark: SparkSession, sf_dir: str):
    return features(Tables(spark, sf_dir))


def split_of(d):
    return (F.when(d < F.lit(SPLIT_VALIDATION_FROM).cast("timestamp"), F.lit("train"))
            .when(d < F.lit(SPLIT_TEST_FROM).cast("timestamp"), F.lit("validation"))
            .otherwise(F.lit("test")))


@query("temporal_split", sql=f"""
WITH {FLIGHTS_SQL}, {_LAB_SQL}
SELECT order_key, line_number, CAST(planned_ts AS DATE) AS planned_date,
       CASE WHEN planned_ts < TIMESTAMP '{SPLIT_VALIDATION_FROM}' THEN 'train'
            WHEN planned_ts < TIMESTAMP '{SPLIT_TEST_FROM}' THEN 'validation' ELSE 'test' END AS split
FROM lab
""")
def q_temporal_split(spark: SparkSession, sf_dir: str):
    lab = labelled(Tables(spark, sf_dir))
    return lab.select("order_key", "line_number", F.to_date("planned_ts").alias("planned_date"),
                      split_of(F.col("planned_ts")).alias("split"))


@query("pr_curve", sql=f"""
WITH {FLIGHTS_SQL}, {_LAB_SQL},
u AS (SELECT order_key, line_number, origin, destination, planned_ts AS t, CAST(NULL AS INTEGER) AS outcome, true AS q
      FROM lab
      UNION ALL SELECT NULL, NULL, origin, destination, real_ts, label, false FROM lab),
tr AS (SELECT order_key, line_number, avg(outcome) OVER w AS score FROM u
       WINDOW w AS (PARTITION BY origin, destination ORDER BY t
                    RANGE BETWEEN INTERVAL {HISTORY_DAYS} DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)),
s AS (SELECT tr.score AS threshold, lab.label FROM lab JOIN tr
        ON lab.order_key = tr.order_key AND lab.line_number = tr.line_number WHERE tr.score IS NOT NULL),
p AS (SELECT threshold, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM s GROUP BY 1),
c AS (SELECT threshold, pos, sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp, sum(pos) OVER () AS all_pos FROM p),
c2 AS (SELECT *, tp / (tp + fp) AS prec FROM c)
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(prec, 6) AS precision,
       round(rec, 6) AS recall,
       round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) END, 6) AS f1,
       round(sum(CASE WHEN all_pos > 0 THEN pos / all_pos * prec END) OVER (), 6) AS average_precision
FROM (SELECT *, CASE WHEN all_pos > 0 THEN tp / all_pos END AS rec FROM c2)
""")
def q_pr_curve(spark: SparkSession, sf_dir: str):
    """PR curve of the 30-day route delay rate used as a score for the delay label."""
    t = Tables(spark, sf_dir)
    lab = labelled(t, flight_base(t))
    scored = route_history(lab.select("origin", "destination", "planned_ts", "real_ts", "label"))
    return pr_curve(scored.select(F.col("route_rate_30d").alias("score"), "label"), "score", "label")


@query("drift_psi", sql=f"""
WITH {FLIGHTS_SQL}, {_LAB_SQL},
long AS (SELECT planned_ts < TIMESTAMP '{SPLIT_VALIDATION_FROM}' AS r, planned_ts >= TIMESTAMP '{SPLIT_TEST_FROM}' AS c,
                'delay_min' AS feature, CAST(delay_min AS DOUBLE) AS x FROM lab
         UNION ALL SELECT planned_ts < TIMESTAMP '{SPLIT_VALIDATION_FROM}', planned_ts >= TIMESTAMP '{SPLIT_TEST_FROM}',
                'quantity', CAST(quantity AS DOUBLE) FROM lab),
l2 AS (SELECT * FROM long WHERE x IS NOT NULL AND (r OR c)),
b AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM l2 WHERE r GROUP BY 1),
binned AS (SELECT l2.feature, r, c,
                  CAST(least(greatest(CASE WHEN (hi - lo) / 10 > 0 THEN floor((x - lo) / ((hi - lo) / 10)) ELSE 0 END, 0), 9)
                       AS INTEGER) AS bin
           FROM l2 JOIN b ON l2.feature = b.feature),
cnt AS (SELECT feature, bin, count_if(r) AS n_ref, count_if(c) AS n_cur FROM binned GROUP BY 1, 2),
grid AS (SELECT feature, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM b),
per AS (SELECT g.feature, g.bin, coalesce(n_ref, 0) AS n_ref, coalesce(n_cur, 0) AS n_cur FROM grid g
        LEFT JOIN cnt ON g.feature = cnt.feature AND g.bin = cnt.bin),
sh AS (SELECT *, greatest(n_ref / sum(n_ref) OVER (PARTITION BY feature), 1e-6) AS rs,
              greatest(n_cur / sum(n_cur) OVER (PARTITION BY feature), 1e-6) AS cs FROM per),
pp AS (SELECT *, (cs - rs) * ln(cs / rs) AS part FROM sh)
SELECT feature, bin, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, round(rs, 6) AS ref_share,
       round(cs, 6) AS cur_share, round(part, 6) AS psi_part, round(sum(part) OVER (PARTITION BY feature), 6) AS psi
FROM pp
""")
def q_drift_psi(spark: SparkSession, sf_dir: str):
    """PSI of delay and quantity between the training period and the test period."""
    t = Tables(spark, sf_dir)
    lab = materialize(labelled(t).select("planned_ts", "delay_min", "quantity"), "drift")
    d = F.col("planned_ts")
    return psi(lab, ["delay_min", "quantity"], d < F.lit(SPLIT_VALIDATION_FROM).cast("timestamp"),
               d >= F.lit(SPLIT_TEST_FROM).cast("timestamp"))


MODEL_FEATURES = ["route_n_30d", "route_rate_30d", "carrier_rate_30d", "origin_rate_30d", "destination_rate_30d", "prev_rain_origin_mm",
                  "prev_rain_mm", "price", "hour", "iso_weekday", "month"]


@query("delay_model_comparison")
def q_delay_model_comparison(spark: SparkSession, sf_dir: str):
    """Baseline logistic regression vs gradient-boosted trees (class-weighted) trained on the
    training period of the feature table and scored on the test period (iterative: no SQL oracle)."""
    from punctua.operators.ml import compare_models, fit_prep, ml_session, train_gbt, train_logistic, with_class_weights
    # models train in their own session: a DataFrame.observe(Observation) earlier in the caller's
    # session would otherwise break the training jobs (Task not serializable: ObservationManager)
    own = ml_session(spark)
    f = features(Tables(own, sf_dir)).select("label", split_of(F.col("planned_ts")).alias("split"), *MODEL_FEATURES)
    f = materialize(f, "features")
    train = with_class_weights(f.filter(F.col("split") == "train"), "label")
    test = f.filter(F.col("split") == "test")
    prep = fit_prep(train, MODEL_FEATURES)
    models = {"logistic_regression": train_logistic(train, MODEL_FEATURES, prep=prep),
              "gradient_boosting": train_gbt(train, MODEL_FEATURES, max_iter=10, max_depth=4, prep=prep)}
    return compare_models(models, test, MODEL_FEATURES)


# Checkable models: features of the fit, its Newton steps, and the fixed formula whose features are permuted.
FIT_FEATURES, FIT_STEPS, FIT_RIDGE = ["load", "weekend"], 6, 1e-6
FORMULA_FEATURES, FORMULA = ["load", "weekend", "month"], [0.4, 0.8, -0.3, 0.05]


def fit_rows(t: Tables):
    lab = labelled(t).where("label IS NOT NULL").select("order_key", "line_number", "planned_ts", "label", "quantity")
    d = F.col("planned_ts")
    return materialize(lab.select("order_key", "line_number", F.to_date(d).alias("day"), "label", (F.col("quantity") / 50.0).alias("load"),
                                  F.when(iso_weekday(d) >= 6, 1.0).otherwise(0.0).alias("weekend"),
                                  F.month(d).cast("double").alias("month")), "fit-rows")


_FIT_SQL = """
fr AS (SELECT order_key, line_number, CAST(planned_ts AS DATE) AS day, label, quantity / 50.0 AS load,
              CASE WHEN isodow(planned_ts) >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weekend, month(planned_ts)::DOUBLE AS month
       FROM lab WHERE label IS NOT NULL),
w0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"""
for _i in range(FIT_STEPS):
    _FIT_SQL += f""",
p{_i} AS (SELECT load AS x, weekend AS y, label, 1 / (1 + exp(-(b0 + b1 * load + b2 * weekend))) AS p, b0, b1, b2 FROM fr, w{_i}),
s{_i} AS (SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, sum(label - p) - {FIT_RIDGE} * any_value(b0) AS g0,
                 sum((label - p) * x) - {FIT_RIDGE} * any_value(b1) AS g1, sum((label - p) * y) - {FIT_RIDGE} * any_value(b2) AS g2,
                 sum(p * (1 - p)) + {FIT_RIDGE} AS a, sum(p * (1 - p) * x) AS b, sum(p * (1 - p) * y) AS c,
                 sum(p * (1 - p) * x * x) + {FIT_RIDGE} AS d, sum(p * (1 - p) * x * y) AS e,
                 sum(p * (1 - p) * y * y) + {FIT_RIDGE} AS f FROM p{_i}),
q{_i} AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM s{_i}),
w{_i + 1} AS (SELECT b0 + (g0 * (d * f - e * e) - b * (g1 * f - e * g2) + c * (g1 * e - d * g2)) / det AS b0,
                     b1 + (a * (g1 * f - e * g2) - g0 * (b * f - c * e) + c * (b * g2 - c * g1)) / det AS b1,
                     b2 + (a * (d * g2 - e * g1) - b * (b * g2 - c * g1) + g0 * (b * e - c * d)) / det AS b2 FROM q{_i})"""


@query("logistic_newton", sql=f"""
WITH {FLIGHTS_SQL}, {_LAB_SQL}, {_FIT_SQL}
SELECT unnest(['intercept', 'load', 'weekend']) AS term, round(unnest([b0, b1, b2]), 6) AS weight FROM w{FIT_STEPS}
""")
def q_logistic_newton(spark: SparkSession, sf_dir: str):
    """Weights of a logistic delay model after a fixed number of Newton steps."""
    weights = newton_logistic(fit_rows(Tables(spark, sf_dir)), FIT_FEATURES, "label", FIT_STEPS, FIT_RIDGE)
    return spark.createDataFrame([(n, round(w, 6)) for n, w in zip(["intercept", *FIT_FEATURES], weights)], "term string, weight double")


@query("logistic_daily_scores", sql=f"""
WITH {FLIGHTS_SQL}, {_LAB_SQL}, {_FIT_SQL}
SELECT day AS score_date, count(*) AS flights, CAST(sum(label) AS BIGINT) AS late, round(avg(p), 6) AS mean_score,
       round(avg((p - label) * (p - label)), 6) AS brier
FROM (SELECT day, label, 1 / (1 + exp(-(b0 + b1 * load + b2 * weekend))) AS p FROM fr, w{FIT_STEPS}) GROUP BY 1
""")
def q_logistic_daily_scores(spark: SparkSession, sf_dir: str):
    """All flights scored by that model, per planned day: mean score, observed delays and squared error."""
    rows = fit_rows(Tables(spark, sf_dir))
    score = linear_score(newton_logistic(rows, FIT_FEATURES, "label", FIT_STEPS, FIT_RIDGE), FIT_FEATURES)
    scored = rows.select(F.col("day").alias("score_date"), "label", score.alias("p"))
    return scored.groupBy("score_date").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("label").cast("bigint").alias("late"), F.round(F.avg("p"), 6).alias("mean_score"),
        F.round(F.avg((F.col("p") - F.col("label")) * (F.col("p") - F.col("label"))), 6).alias("brier"))


def _loss_sql(feature: str | None) -> str:
    x = [f"{f}_p" if f == feature else f for f in FORMULA_FEATURES]
    z = " + ".join([str(FORMULA[0]), *[f"{w} * coalesce({c}, 0)" for w, c in zip(FORMULA[1:], x)]])
    p = f"least(greatest(1 / (1 + exp(-({z}))), 1e-9), 1 - 1e-9)"
    return f"avg(-(label * ln({p}) + (1 - label) * ln(1 - {p})))"


_PERM_SQL = ",\n".join(f"""x_{f} AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN last_value({f}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
    AND UNBOUNDED FOLLOWING) ELSE lag({f}) OVER w END AS {f}_p FROM fr
    WINDOW w AS (ORDER BY md5(order_key || ':' || line_number || ':{f}'), order_key, line_number))""" for f in FORMULA_FEATURES)


@query("permutation_importance", sql=f"""
WITH {FLIGHTS_SQL}, {_LAB_SQL}, {_FIT_SQL},
{_PERM_SQL},
l AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, {_loss_sql(f)} AS loss FROM x_{f}" for f in FORMULA_FEATURES)}),
o AS (SELECT {_loss_sql(None)} AS base_loss FROM fr)
SELECT feature, round(loss, 6) AS loss, round(base_loss, 6) AS base_loss, round(loss - base_loss, 6) AS importance FROM l, o
""")
def q_permutation_importance(spark: SparkSession, sf_dir: str):
    """How much the mean log loss of a fixed formula grows when each of its features is permuted."""
    rows = fit_rows(Tables(spark, sf_dir))
    out = permutation_importance(rows, lambda: linear_score(FORMULA, FORMULA_FEATURES), FORMULA_FEATURES, "label", ["order_key", "line_number"])
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("loss", "base_loss", "importance")])

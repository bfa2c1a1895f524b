"""Model queries: M02-M12."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import series as sr
from ..operators.ranks import area_under_curve
from ..plans import silver
from ..plans.scoring import anomaly, churn, features, forecast, grams
from ..sources.bridge import CHURN_SCORE
from ..sources.tables import staged
from .base import Frames, register

KEYS = ["booking_id", "car_id", "payment_id"]

register("m02_demand_forecast", lambda f: forecast.forecast(f.daily).drop("created_at"))
register("m03_backtest", lambda f: forecast.backtest(f.daily))
register(
    "m03_backtest_folds",
    lambda f: forecast.with_cutoffs(f.daily).groupBy("cutoff").agg(
        F.count_if(F.col("ds") <= F.col("cutoff")).alias("trained"),
        F.count_if(F.col("ds") > F.col("cutoff")).alias("tested"),
    ),
    """SELECT cutoff, count(*) FILTER (ds <= cutoff) AS trained, count(*) FILTER (ds > cutoff) AS tested
       FROM (SELECT CAST(last - 15 - 7 * i AS DATE) AS cutoff
             FROM (SELECT min(ds) AS first, max(ds) AS last, count(*) AS n FROM f_daily)
             CROSS JOIN (SELECT CAST(unnest(range(0, 2000)) AS INTEGER) AS i)
             WHERE last - 15 - 7 * i >= first + CAST(greatest(30, floor(n / 2)) AS INTEGER) AND n >= 60)
       JOIN f_daily ON ds <= cutoff + 15 GROUP BY cutoff""",
)

# Trend and weekday by SQL: least squares with a level for each weekday is a slope over the deviations from its means.
_WEEKDAY = "(CAST(strftime({}, '%w') AS INTEGER) + 6) % 7"
register(
    "m03_weekday_backtest",
    lambda f: grams.backtest(f.daily, terms=grams.weekday_terms, ridge=0.0).withColumn("mape", F.round("mape", 6)),
    f"""WITH span AS (SELECT min(ds) AS first, max(ds) AS last, count(*) AS n FROM f_daily),
        cuts AS (SELECT CAST(last - 15 - 7 * i AS DATE) AS cutoff FROM span
                 CROSS JOIN (SELECT CAST(unnest(range(0, 2000)) AS INTEGER) AS i)
                 WHERE last - 15 - 7 * i >= first + CAST(greatest(30, floor(n / 2)) AS INTEGER) AND n >= 60),
        days AS (SELECT ds, CAST(y AS DOUBLE) AS y, CAST(date_diff('day', DATE '2000-01-01', ds) AS DOUBLE) / 365.25 AS t,
                        {_WEEKDAY.format('ds')} AS w FROM f_daily),
        means AS (SELECT cutoff, w, avg(t) AS mt, avg(y) AS my FROM cuts JOIN days ON ds <= cutoff GROUP BY ALL),
        slopes AS (SELECT m.cutoff, sum((t - mt) * (y - my)) / sum((t - mt) * (t - mt)) AS slope
                   FROM means m JOIN days d ON d.ds <= m.cutoff AND d.w = m.w GROUP BY m.cutoff)
        SELECT cutoff, CAST(count(*) AS INTEGER) AS tested,
               round(avg(abs(greatest(my + slope * (t - mt), 0) - y) / y) * 100, 6) AS mape
        FROM cuts JOIN days ON ds > cutoff AND ds <= cutoff + 15 JOIN means USING (cutoff, w) JOIN slopes USING (cutoff)
        WHERE y > 0 GROUP BY cutoff""",
)


def _series(f: Frames):
    """Routes of one pick-up place are a series each; most have too few days for a model of their own."""
    by = ["pickup_location", "trip_type"]
    found = grams.series_forecast(grams.series_counts(f.mart, by), by, terms=grams.weekday_terms, ridge=0.0)
    return found.withColumns({c: F.round(c, 5) for c in ("predicted_bookings", "lower_bound", "upper_bound")})


register(
    "m02_series_forecast",
    _series,
    f"""WITH days AS (
          SELECT pickup_location AS p, trip_type AS q, ds, y, CAST(date_diff('day', DATE '2000-01-01', ds) AS DOUBLE) / 365.25 AS t,
                 {_WEEKDAY.format('ds')} AS w
          FROM (SELECT pickup_location, trip_type, booking_date AS ds, CAST(count(*) AS DOUBLE) AS y FROM f_serving
                WHERE booking_date IS NOT NULL GROUP BY ALL)),
        pooling AS (SELECT *, FALSE AS pool FROM days UNION ALL SELECT 'all', 'all', ds, y, t, w, TRUE FROM days),
        means AS (SELECT p, q, pool, w, avg(t) AS mt, avg(y) AS my FROM pooling GROUP BY ALL),
        slopes AS (SELECT p, q, pool, sum((t - mt) * (y - my)) / sum((t - mt) * (t - mt)) AS slope
                   FROM means JOIN pooling USING (p, q, pool, w) GROUP BY ALL),
        fits AS (SELECT p, q, pool, any_value(slope) AS slope, count(*) AS n, avg(y) AS level,
                        sqrt(avg((y - my - slope * (t - mt)) ** 2)) AS rmse
                 FROM pooling JOIN means USING (p, q, pool, w) JOIN slopes USING (p, q, pool) GROUP BY ALL),
        ahead AS (SELECT d, CAST(date_diff('day', DATE '2000-01-01', d) AS DOUBLE) / 365.25 AS t, {_WEEKDAY.format('d')} AS w
                  FROM (SELECT CAST(max(ds) + CAST(unnest(range(1, 31)) AS INTEGER) AS DATE) AS d FROM days)),
        guesses AS (SELECT p, q, pool, d, my + slope * (t - mt) AS g FROM ahead JOIN means USING (w) JOIN slopes USING (p, q, pool)),
        made AS (SELECT f.p, f.q, g.d, g.g, f.rmse, FALSE AS pooled FROM fits f JOIN guesses g USING (p, q, pool)
                 WHERE NOT f.pool AND f.n >= 60
                 UNION ALL
                 SELECT f.p, f.q, g.d, g.g * f.level / a.level, a.rmse * f.level / a.level, TRUE
                 FROM fits f CROSS JOIN (SELECT * FROM fits WHERE pool) a CROSS JOIN (SELECT * FROM guesses WHERE pool) g
                 WHERE NOT f.pool AND f.n < 60)
        SELECT p AS pickup_location, q AS trip_type, d AS forecast_date, round(greatest(g, 0.0), 5) AS predicted_bookings,
               round(greatest(g - {forecast.INTERVAL_Z} * rmse, 0.0), 5) AS lower_bound,
               round(greatest(g + {forecast.INTERVAL_Z} * rmse, 0.0), 5) AS upper_bound, pooled FROM made""",
)


def _codes(f: Frames):
    payments = silver.silver_payments(f.b_payments, payment_counts=False)
    return features.curated_codes(f.booking, f.customer, f.cars, payments, features.CATEGORIES, KEYS)


register(
    "m04_category_codes",
    _codes,
    "SELECT booking_id, car_id, payment_id, "
    + ", ".join(
        f"CAST(dense_rank() OVER (ORDER BY coalesce(CAST({c} AS VARCHAR), 'None')) - 1 AS INTEGER) AS {c}_code"
        for c in features.CATEGORIES
    )
    + " FROM f_serving",
)
register("m05_anomaly_scores", lambda f: anomaly.detect(f.serving))
register(
    "m06_risk_scores",
    lambda f: sr.min_max_risk(
        f.mart.select("booking_id", F.expr(f"-({CHURN_SCORE.replace('customer_id', 'booking_id')})").alias("anomaly")),
        "anomaly",
    ).withColumn("risk_label", rules.fraud_risk_label(F.col("fraud_risk_score"))),
    """SELECT *, CASE WHEN fraud_risk_score <= 25 THEN 'LOW' WHEN fraud_risk_score <= 50 THEN 'MEDIUM'
                      WHEN fraud_risk_score <= 75 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_label
       FROM (SELECT booking_id, anomaly, greatest(0.0, least(100.0, round((anomaly - max(anomaly) OVER ())
                    / (min(anomaly) OVER () - max(anomaly) OVER () + 1e-9) * 100, 2))) AS fraud_risk_score
             FROM (SELECT booking_id, -(CAST((CAST(substr(booking_id, 2) AS BIGINT) * 7919) % 1001 AS DOUBLE) / 1000)
                            AS anomaly FROM f_serving))""",
)
AS_OF = "2001-09-01"


def _labelled(f: Frames):
    return churn.label_churn(f.mart, F.lit(AS_OF).cast("date"))


BEHAVIOUR = """(loyalty_tier IN ('bronze', 'new', 'silver') AND coalesce(payment_amount < mean * 0.5, FALSE)
                AND NOT is_high_value_customer)"""
register(
    "m07_churn_labels",
    lambda f: _labelled(f).select(*KEYS, "days_since_last_booking", "behaviour_label", "churn_label"),
    f"""WITH recent AS (SELECT *, CAST(date_diff('day', max(booking_date) OVER (PARTITION BY customer_id),
                              DATE '{AS_OF}') AS INTEGER) AS days FROM f_serving),
        cuts AS (SELECT greatest(60, CAST(floor(quantile_cont(days, 0.3)) AS INTEGER)) AS t,
                        CAST(sum(CAST(round(payment_amount * 100) AS BIGINT)) AS DOUBLE) / 100.0 / count(payment_amount)
                          AS mean FROM recent)
        SELECT booking_id, car_id, payment_id, days AS days_since_last_booking,
               CAST({BEHAVIOUR} AS INTEGER) AS behaviour_label,
               CAST((days > t OR {BEHAVIOUR}) AS INTEGER) AS churn_label FROM recent CROSS JOIN cuts""",
)


def _single_class(f: Frames):
    """Every row active and nobody conspicuous, so the amount quantile has to make the classes."""
    flat = f.mart.select(*KEYS, "payment_amount", F.lit(0).alias("churn_label"), F.lit(0).alias("behaviour_label"))
    return churn.both_classes(flat).select(*KEYS, "churn_label")


register(
    "m08_single_class_fallback",
    _single_class,
    """SELECT booking_id, car_id, payment_id, CAST(coalesce(payment_amount < q, FALSE) AS INTEGER) AS churn_label
       FROM f_serving CROSS JOIN (SELECT quantile_cont(payment_amount, 0.3) AS q FROM f_serving)""",
)


def _split_sizes(f: Frames):
    # Written once: the split reads its rows for the cuts and for both parts.
    train, test = churn.split(staged(_labelled(f).select(*KEYS, "churn_label"), "labelled"))
    named = train.withColumn("held", F.lit(0)).unionByName(test.withColumn("held", F.lit(1)))
    return named.groupBy("churn_label").agg(F.count(F.lit(1)).alias("n"), F.sum("held").alias("tested"))


register(
    "m09_stratified_split",
    _split_sizes,
    f"""WITH recent AS (SELECT *, CAST(date_diff('day', max(booking_date) OVER (PARTITION BY customer_id),
                              DATE '{AS_OF}') AS INTEGER) AS days FROM f_serving),
        cuts AS (SELECT greatest(60, CAST(floor(quantile_cont(days, 0.3)) AS INTEGER)) AS t,
                        CAST(sum(CAST(round(payment_amount * 100) AS BIGINT)) AS DOUBLE) / 100.0 / count(payment_amount)
                          AS mean FROM recent)
        SELECT CAST((days > t OR {BEHAVIOUR}) AS INTEGER) AS churn_label, count(*) AS n,
               CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS tested
        FROM recent CROSS JOIN cuts GROUP BY 1""",
)


def _train(f: Frames):
    """The classifier, the rows it scores and the hold-out."""
    featured = churn.training_frame(f.serving, F.lit(AS_OF).cast("date"))
    train, test = churn.split(featured)
    return churn.fit(train), featured, test


def _auc(f: Frames):
    model, _, test = _train(f)
    return churn.auc(churn.hold_out_scores(model, test)).withColumn("auc", F.round("auc", 4))


def _scores(f: Frames):
    model, featured, test = _train(f)
    area = churn.auc(churn.hold_out_scores(model, test)).first().auc
    return churn.roll_up(churn.score(model, featured), area)


register("m10_churn_scores", _scores)
register("m11_hold_out_auc", _auc)


def _exact_auc(f: Frames):
    """The rank sum over every serving row: a given score against the churn label, ties counted half."""
    scored = _labelled(f).withColumn("p", F.expr(CHURN_SCORE.replace("customer_id", "booking_id")))
    return area_under_curve(scored, "p", "churn_label").withColumn("auc", F.round("auc", 9))


register(
    "m11_exact_auc",
    _exact_auc,
    f"""WITH recent AS (SELECT *, CAST(date_diff('day', max(booking_date) OVER (PARTITION BY customer_id),
                              DATE '{AS_OF}') AS INTEGER) AS days FROM f_serving),
        cuts AS (SELECT greatest(60, CAST(floor(quantile_cont(days, 0.3)) AS INTEGER)) AS t,
                        CAST(sum(CAST(round(payment_amount * 100) AS BIGINT)) AS DOUBLE) / 100.0 / count(payment_amount)
                          AS mean FROM recent),
        labelled AS (SELECT CAST((CAST(substr(booking_id, 2) AS BIGINT) * 7919) % 1001 AS DOUBLE) / 1000 AS p,
                            CAST((days > t OR {BEHAVIOUR}) AS INTEGER) AS label FROM recent CROSS JOIN cuts),
        ranked AS (SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM labelled)
        SELECT count(*) AS tested,
               round((sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0)
                     / (CAST(sum(label) AS DOUBLE) * CAST(count(*) - sum(label) AS DOUBLE)), 9) AS auc FROM ranked""",
)
register(
    "m12_customer_roll_up",
    lambda f: churn.roll_up(
        f.mart.withColumn("churn_probability", F.expr(CHURN_SCORE.replace("customer_id", "booking_id"))), 0.8
    ),
    """SELECT customer_id, min(customer_name) AS customer_name, min(loyalty_tier) AS loyalty_tier,
              min(points_tier) AS points_tier, bool_and(is_high_value_customer) AS is_high_value_customer,
              max(p) AS churn_probability,
              CASE WHEN max(p) <= 0.3 THEN 'LOW' WHEN max(p) <= 0.6 THEN 'MEDIUM' WHEN max(p) <= 0.8 THEN 'HIGH'
                   ELSE 'CRITICAL' END AS churn_risk,
              CAST(0.8 AS DOUBLE) AS model_auc, 'gradient_boosted_trees' AS model_name
       FROM (SELECT *, CAST((CAST(substr(booking_id, 2) AS BIGINT) * 7919) % 1001 AS DOUBLE) / 1000 AS p FROM f_serving)
       WHERE customer_id IS NOT NULL GROUP BY customer_id""",
)


# What models return can be told without their trees: which rows, bounds, and labels that follow from the scores. Few
# trees make it as well as many.
FEW_TREES = 10


def _forest_contract(f: Frames):
    """Rows of each booking with a score, whether bounds and labels hold, and whether the flagged are the rare share."""
    scored = anomaly.detect(f.serving, trees=FEW_TREES)
    score = F.col("fraud_risk_score")
    fits = score.between(0, 100) & (F.col("risk_label") == rules.fraud_risk_label(score))
    whole = scored.agg(
        ((F.min(score) == 0) & (F.max(score) == 100) & (F.avg("is_fraud") <= anomaly.CONTAMINATION)).alias("w")
    )
    counted = scored.groupBy("booking_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(fits).alias("fits"))
    return counted.withColumn("scaled", whole.scalar())


register(
    "m05_scored_rows",
    _forest_contract,
    "SELECT booking_id, count(*) AS n, TRUE AS fits, TRUE AS scaled FROM f_serving GROUP BY booking_id",
)


def _classifier_contract(f: Frames):
    """Customers with a probability, whether their label follows from it, and whether the AUC beats guessing."""
    scored = churn.predict_churn(f.serving, F.lit(AS_OF).cast("date"), trees=FEW_TREES)
    p = F.col("churn_probability")
    fits = p.between(0, 1) & (F.col("churn_risk") == rules.churn_risk_label(p)) & (F.col("model_auc") > 0.5)
    return scored.select("customer_id", "loyalty_tier", "points_tier", fits.alias("fits"))


register(
    "m10_scored_customers",
    _classifier_contract,
    """SELECT DISTINCT customer_id, loyalty_tier, points_tier, TRUE AS fits FROM f_serving WHERE customer_id IS NOT NULL""",
)

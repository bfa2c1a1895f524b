"""Bronze, silver and curated queries: P*, J*."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import rules
from ..operators import frames as fr
from ..operators import hyperplanes, keyed, upsert, vectors
from ..plans import monitoring as mon
from ..plans import silver
from ..plans.curated import curate
from ..sources import bridge, events
from .base import Frames, register

EVENT_ROWS = "f_b_booking b LEFT JOIN lineitem l ON b.booking_id = 'B' || CAST(l.l_orderkey AS VARCHAR)"


# -- projections and rules -----------------------------------------------------------------------------------

def _nested(f: Frames):
    return bridge.nested_events(f.spark, f.sf_dir)


register(
    "p01_nested_projection",
    lambda f: events.flatten_booking(_nested(f)),
    f"""SELECT b.booking_id, booking_date, customer_id, customer_name, email, loyalty_tier, loyalty_points,
               pickup_location, pickup_time, drop_location, drop_time FROM {EVENT_ROWS}""",
)
register(
    "p02_explode_cars",
    lambda f: events.bronze_cars(_nested(f)).drop("ingested_at"),
    "SELECT booking_id, car_id, model, price_per_day, insurance_provider, insurance_coverage FROM f_b_cars",
)
register(
    "p02_explode_payments",
    lambda f: events.bronze_payments(_nested(f)).drop("ingested_at"),
    "SELECT booking_id, payment_id, payment_method, payment_amount FROM f_b_payments",
)
register(
    "p03_trim_lower",
    lambda f: f.b_booking.select(
        "booking_id",
        rules.clean(F.col("pickup_location")).alias("pickup_location"),
        rules.clean_lower(F.col("loyalty_tier")).alias("loyalty_tier"),
        rules.clean_lower(F.col("email")).alias("email"),
    ),
    """SELECT booking_id, trim(pickup_location) AS pickup_location, lower(trim(loyalty_tier)) AS loyalty_tier,
              lower(trim(email)) AS email FROM f_b_booking""",
)
register(
    "p04_safe_cast",
    lambda f: f.b_booking.select(
        "booking_id",
        rules.safe_date(F.col("booking_date")).alias("booking_date"),
        rules.safe_int(F.col("pickup_time")).alias("time_as_int"),
        rules.safe_int(F.expr("substr(booking_id, 2)")).alias("id_as_int"),
        rules.safe_double(F.col("customer_name")).alias("name_as_double"),
    ),
    """SELECT booking_id, TRY_CAST(booking_date AS DATE) AS booking_date, TRY_CAST(pickup_time AS INTEGER) AS time_as_int,
              TRY_CAST(substr(booking_id, 2) AS INTEGER) AS id_as_int,
              TRY_CAST(customer_name AS DOUBLE) AS name_as_double FROM f_b_booking""",
)
register(
    "p05_money",
    lambda f: f.b_payments.select("payment_id", rules.money(F.col("payment_amount")).alias("payment_amount")),
    "SELECT payment_id, round(payment_amount, 2) AS payment_amount FROM f_b_payments",
)

# Rules whose silver column is compared as a whole: key, frame, columns.
SILVER_RULES = [
    ("p06_email_domain", "customer", "customer_id, email, email_domain"),
    ("p07_loyalty_tier", "customer", "customer_id, loyalty_tier"),
    ("p08_loyalty_rank", "customer", "customer_id, loyalty_rank"),
    ("p09_high_value", "customer", "customer_id, is_high_value_customer"),
    ("p10_points_default", "customer", "customer_id, loyalty_points"),
    ("p11_points_tier", "customer", "customer_id, points_tier"),
    ("p12_pickup_hour", "booking", "booking_id, pickup_time, pickup_hour"),
    ("p13_pickup_slot", "booking", "booking_id, pickup_slot"),
    ("p14_trip_type", "booking", "booking_id, trip_type"),
    ("p15_route", "booking", "booking_id, route"),
    ("p16_date_parts", "booking", "booking_id, booking_date, booking_year, booking_month"),
    ("p17_price_tier", "cars", "booking_id, car_id, price_per_day, price_tier"),
    ("p18_insurance_coverage", "cars", "booking_id, car_id, insurance_coverage"),
    ("p19_has_full_insurance", "cars", "booking_id, car_id, has_full_insurance"),
    ("p20_insurer_type", "cars", "booking_id, car_id, insurer_type"),
    ("p21_car_segment", "cars", "booking_id, car_id, car_segment"),
    ("p22_payment_method", "payments", "payment_id, payment_method"),
    ("p23_is_digital", "payments", "payment_id, is_digital_payment"),
    ("p24_amount_tier", "payments", "payment_id, amount_tier"),
]


def _columns(frame: str, names: str):
    columns = names.split(", ")
    if frame == "payments":
        return lambda f: silver.silver_payments(f.b_payments, payment_counts=False).select(*columns)
    return lambda f: getattr(f, frame).select(*columns)


for _key, _frame, _names in SILVER_RULES:
    register(_key, _columns(_frame, _names), f"SELECT {_names} FROM f_{_frame}")

register(
    "p25_audit_stamp",
    lambda f: silver.silver_booking(f.b_booking, audit=True).select(
        "booking_id", (F.col("transformed_at") <= F.current_timestamp()).alias("stamped")
    ),
    "SELECT booking_id, TRUE AS stamped FROM f_booking",
)
register(
    "p26_drop_columns",
    lambda f: curate(
        silver.silver_booking(f.b_booking, audit=True), silver.silver_customer(f.b_booking, audit=True), f.cars, f.payments
    ).select("*").drop("email", "no_such_column").select(
        "booking_id", "car_id", "payment_id", "booking_year", F.lit(True).alias("kept")
    ),
    "SELECT booking_id, car_id, payment_id, booking_year, TRUE AS kept FROM f_serving",
)
FILTERS = {"loyalty_tier": "gold", "payment_method": "upi", "trip_type": None, "no_such_column": "x"}
register(
    "p27_filters",
    lambda f: fr.apply_filters(f.mart, FILTERS).select("booking_id", "car_id", "payment_id"),
    "SELECT booking_id, car_id, payment_id FROM f_serving WHERE loyalty_tier = 'gold' AND payment_method = 'upi'",
)
register(
    "p28_filter_badge",
    lambda f: fr.filter_badge(f.mart, FILTERS),
    """SELECT count(*) FILTER (loyalty_tier = 'gold' AND payment_method = 'upi') AS kept, count(*) AS total,
              kept <> total AS active FROM f_serving""",
)
register(
    "p29_recency",
    lambda f: fr.since_days(f.booking, "booking_date", 90, f.last_day).select("booking_id", "booking_date"),
    """SELECT booking_id, booking_date FROM f_booking
       WHERE booking_date >= (SELECT max(booking_date) FROM f_booking) - 90""",
)
register(
    "p30_last_hours",
    lambda f: fr.since_hours(f.alerts, "created_at", 24, f.last_event).select("error_message", "alert_type"),
    """SELECT error_message, alert_type FROM f_alerts
       WHERE created_at >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""",
)
FRAUD_COLUMNS = ["booking_id", "customer_id", "route", "payment_amount", "fraud_risk_score", "risk_label"]
register(
    "p31_top_fraud",
    lambda f: mon.top_scored(
        f.fraud.select(*FRAUD_COLUMNS, "car_id", "payment_id"), score="fraud_risk_score",
        key=["booking_id", "payment_id", "car_id", "route"], label="risk_label", value="CRITICAL", limit=100,
    ).select(*FRAUD_COLUMNS),
    f"""SELECT {', '.join(FRAUD_COLUMNS)} FROM f_fraud WHERE risk_label = 'CRITICAL'
        ORDER BY fraud_risk_score DESC, booking_id, payment_id NULLS FIRST, car_id NULLS FIRST LIMIT 100""",
)
register(
    "p31_top_churn",
    lambda f: mon.top_scored(
        f.churn, score="churn_probability", key=["customer_id"], label="churn_risk", limit=100
    ).select("customer_id", "loyalty_tier", "churn_probability", "churn_risk", F.round("model_auc", 4).alias("model_auc")),
    """SELECT customer_id, loyalty_tier, churn_probability, churn_risk, round(model_auc, 4) AS model_auc FROM f_churn
       ORDER BY churn_probability DESC, customer_id LIMIT 100""",
)
register(
    "p32_filter_options",
    lambda f: fr.distinct_values(silver.silver_payments(f.b_payments, payment_counts=False), "payment_method"),
    "SELECT DISTINCT payment_method FROM f_payments WHERE payment_method IS NOT NULL ORDER BY 1",
)
register(
    "p33_rule_labels",
    lambda f: f.details.select("run_identifier", rules.rule_label(F.col("expectation_type")).alias("rule")),
    """SELECT run_identifier, replace(replace(replace(expectation_type, 'expect_column_values_to_be_', ''),
              'expect_column_', ''), '_', ' ') AS rule FROM f_details""",
)
register(
    "p34_bounded_fetch",
    lambda f: fr.top(
        f.failed, 500, [F.col("run_identifier").desc()], ["booking_id"]
    ).select("run_identifier", "booking_id", "column_name"),
    """SELECT run_identifier, booking_id, column_name FROM f_failed
       ORDER BY run_identifier DESC, booking_id LIMIT 500""",
)
register(
    "p35_fraud_bands",
    lambda f: bridge.fraud_scores(f.mart).select("booking_id", "fraud_risk_score", "risk_label"),
    """SELECT booking_id, s AS fraud_risk_score,
              CASE WHEN s <= 25 THEN 'LOW' WHEN s <= 50 THEN 'MEDIUM' WHEN s <= 75 THEN 'HIGH' ELSE 'CRITICAL' END
                AS risk_label
       FROM (SELECT booking_id, CAST((CAST(substr(booking_id, 2) AS BIGINT) * 7919) % 10001 AS DOUBLE) / 100 AS s
             FROM f_serving)""",
)
register(
    "p35_churn_bands",
    lambda f: f.churn.select("customer_id", "churn_probability", "churn_risk"),
    "SELECT customer_id, churn_probability, churn_risk FROM f_churn",
)
register(
    "p36_clip",
    lambda f: f.b_payments.select(
        "payment_id",
        rules.clip(rules.money(F.col("payment_amount")), 5000.0, 10000.0).alias("clipped"),
        rules.clip(rules.money(F.col("payment_amount")), low=5000.0).alias("floored"),
    ),
    """SELECT payment_id, greatest(least(round(payment_amount, 2), 10000.0), 5000.0) AS clipped,
              greatest(round(payment_amount, 2), 5000.0) AS floored FROM f_b_payments""",
)
register(
    "p37_fill_nulls",
    lambda f: f.mart.select("booking_id", "car_id", "payment_id", "payment_amount", "has_full_insurance")
    .na.fill({"payment_amount": 0.0, "has_full_insurance": False, "car_id": "None"}),
    """SELECT booking_id, coalesce(car_id, 'None') AS car_id, payment_id, coalesce(payment_amount, 0) AS payment_amount,
              coalesce(has_full_insurance, FALSE) AS has_full_insurance FROM f_serving""",
)

# -- keys and joins ---------------------------------------------------------------------------------------------

BOOKING_PICK = ["customer_id", "booking_date", "booking_id", "route"]
register(
    "j01_newest_per_key",
    lambda f: keyed.newest_per_key(f.booking.select(*BOOKING_PICK), ["customer_id"], ["booking_date", "booking_id"]),
    """SELECT customer_id, booking_date, booking_id, route FROM (
         SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY booking_date DESC, booking_id DESC) AS r
         FROM f_booking) WHERE r = 1""",
)
register(
    "j02_booking_customer",
    lambda f: keyed.lookup_left_join(f.booking, f.customer, ["customer_id"]).select(
        "booking_id", "customer_id", "customer_name", "email", "loyalty_tier", "loyalty_points"
    ),
    """SELECT booking_id, customer_id, customer_name, email, loyalty_tier, loyalty_points
       FROM f_booking LEFT JOIN f_customer USING (customer_id)""",
)
register(
    "j03_booking_cars",
    lambda f: keyed.fan_out_left_join(f.booking, [f.cars], "booking_id").select(
        "booking_id", "route", "car_id", "model", "price_per_day"
    ),
    """SELECT booking_id, route, car_id, model, price_per_day FROM f_booking LEFT JOIN f_cars USING (booking_id)""",
)
register("j04_serving_table", lambda f: f.serving, "SELECT * FROM f_serving")
register(
    "j05_payment_counts",
    lambda f: f.payments.select("payment_id", "booking_id", "payment_count", "is_split_payment"),
    "SELECT payment_id, booking_id, payment_count, is_split_payment FROM f_payments",
)
ATTRIBUTES = """customer_name, route, trip_type, pickup_hour, payment_method, payment_amount, is_split_payment,
       car_segment, loyalty_tier"""
register(
    "j06_top_critical",
    lambda f: mon.top_critical(f.fraud, f.serving),
    f"""SELECT s.booking_id, fraud_risk_score, risk_label, {ATTRIBUTES}
        FROM (SELECT booking_id, fraud_risk_score, risk_label FROM f_fraud WHERE risk_label = 'CRITICAL'
              ORDER BY fraud_risk_score DESC, booking_id LIMIT 1) t JOIN f_serving s ON t.booking_id = s.booking_id
        ORDER BY payment_id NULLS LAST, car_id NULLS LAST LIMIT 1""",
)
register(
    "j07_actual_forecast",
    lambda f: mon.actual_against_forecast(f.daily, f.forecast).withColumnRenamed("forecast_date", "ds"),
    """SELECT ds, y AS actual, predicted_bookings FROM f_daily JOIN f_forecast ON ds = forecast_date""",
)
register(
    "j08_days_since_last",
    lambda f: keyed.days_since_last(
        f.mart.select("booking_id", "customer_id", "booking_date"), "customer_id", "booking_date",
        F.lit("2002-01-01").cast("date"), fixed.UNSEEN_DAYS,
    ).drop("booking_date"),
    """SELECT booking_id, customer_id, max(booking_date) OVER (PARTITION BY customer_id) AS last_booking_date,
              CAST(date_diff('day', max(booking_date) OVER (PARTITION BY customer_id), DATE '2002-01-01') AS INTEGER)
                AS days_since_last_booking FROM f_serving""",
)


def _period(f: Frames, condition: str):
    """The newest booking per customer of one loading period."""
    rows = f.booking.filter(condition).select(*BOOKING_PICK)
    return keyed.newest_per_key(rows, ["customer_id"], ["booking_date", "booking_id"])


OLD, NEW = "booking_date < DATE '1999-07-01'", "booking_date >= DATE '1999-01-01'"
PERIOD_SQL = """SELECT customer_id, booking_date, booking_id, route FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY booking_date DESC, booking_id DESC) AS r
  FROM f_booking WHERE {}) WHERE r = 1"""
register(
    "j09_upsert_single_key",
    lambda f: upsert.merged(_period(f, OLD), _period(f, NEW), ["customer_id"]),
    f"""SELECT * FROM ({PERIOD_SQL.format(NEW)}) UNION ALL
        SELECT * FROM ({PERIOD_SQL.format(OLD)}) o
        WHERE customer_id NOT IN (SELECT customer_id FROM ({PERIOD_SQL.format(NEW)}))""",
)


def _repriced(f: Frames):
    """Silver cars, one per (booking, car), and the fully insured of them at a new price."""
    keys = ["booking_id", "car_id"]
    target = upsert.unique_source(f.cars.select(*keys, "price_per_day", "insurance_provider", "insurance_coverage"), keys)
    source = target.filter("insurance_coverage = 'full'").withColumn("price_per_day", F.col("price_per_day") + 100)
    return upsert.merged(target, source, keys, unique=True)


register(
    "j10_upsert_composite_key",
    _repriced,
    """SELECT booking_id, car_id, price_per_day + CASE WHEN insurance_coverage = 'full' THEN 100 ELSE 0 END
              AS price_per_day, insurance_provider, insurance_coverage FROM (
         SELECT *, row_number() OVER (PARTITION BY booking_id, car_id
                ORDER BY price_per_day DESC, insurance_provider DESC, insurance_coverage DESC) AS r FROM f_cars)
       WHERE r = 1""",
)


def _curated_upsert(f: Frames):
    """Two overlapping loads of the curated table, keyed null-safely by its grain."""
    keys = ["booking_id", "car_id", "payment_id"]
    wide = f.mart.select(*keys, "booking_date", "payment_amount", "price_per_day", "insurance_provider")
    old, new = (upsert.unique_source(wide.filter(c), keys) for c in (OLD, NEW))
    return upsert.merged(old, new, keys, unique=True).drop("insurance_provider")


register(
    "j11_upsert_curated",
    _curated_upsert,
    """SELECT DISTINCT booking_id, car_id, payment_id, booking_date, payment_amount, price_per_day FROM f_serving""",
)
register(
    "j12_duplicated_keys",
    lambda f: keyed.duplicated(f.cars, ["booking_id", "car_id"]).select(
        "booking_id", "car_id", "insurance_provider", "insurance_coverage"
    ),
    """SELECT booking_id, car_id, insurance_provider, insurance_coverage FROM f_cars
       WHERE (booking_id, car_id) IN (SELECT (booking_id, car_id) FROM f_cars GROUP BY booking_id, car_id
                                      HAVING count(*) > 1)""",
)
register(
    "j13_latest_run",
    lambda f: keyed.latest_run_rows(f.failed, f.results, "run_identifier", "created_at").select(
        "run_identifier", "booking_id", "column_name", "failed_reason"
    ),
    """SELECT run_identifier, booking_id, column_name, failed_reason FROM f_failed
       WHERE run_identifier = (SELECT run_identifier FROM f_results ORDER BY created_at DESC, run_identifier DESC LIMIT 1)""",
)
register(
    "j14_not_in_set",
    lambda f: f.mart.filter(keyed.not_in(F.col("insurance_coverage"), ["full", "partial"])).select(
        "booking_id", "car_id", "payment_id", "insurance_coverage"
    ),
    """SELECT booking_id, car_id, payment_id, insurance_coverage FROM f_serving
       WHERE insurance_coverage NOT IN ('full', 'partial')""",
)


def _centroids(f: Frames):
    """One question per label: the mean vector of the label."""
    cells = f.table("embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    gathered = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("v"))
    return gathered.select("label", F.transform("v", lambda e: e["m"]).alias("question"))


CENTROID_SQL = """SELECT label, list(m ORDER BY pos) AS question FROM (
  SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS m
  FROM embeddings, (SELECT unnest(range(1, 1 + (SELECT max(len(embedding)) FROM embeddings))) AS pos) GROUP BY label, pos)
  GROUP BY label"""
register(
    "j15_nearest",
    lambda f: vectors.nearest(
        f.table("embeddings"),
        _centroids(f).agg(F.min_by("question", "label")).scalar(),
        5, key="vec_id", vector="embedding",
    ).select("vec_id", "similarity"),
    f"""SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), question), 6) AS similarity
        FROM embeddings, (SELECT question FROM ({CENTROID_SQL}) ORDER BY label LIMIT 1) q
        ORDER BY similarity DESC, vec_id LIMIT 5""",
)
register(
    "j15_nearest_batch",
    lambda f: vectors.nearest_batch(
        f.table("embeddings"), _centroids(f), 5,
        key="vec_id", vector="embedding", query_key="label", query_vector="question",
    ),
    f"""SELECT label, vec_id, similarity, rank FROM (
          SELECT q.label, vec_id, similarity,
                 CAST(row_number() OVER (PARTITION BY q.label ORDER BY similarity DESC, vec_id) AS INTEGER) AS rank
          FROM (SELECT q.label, e.vec_id,
                       round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.question), 6) AS similarity
                FROM embeddings e, ({CENTROID_SQL}) q) q) WHERE rank <= 5""",
)


def _approximate(f: Frames):
    """Every twentieth vector as a question: what hyperplane tables find against the exact search."""
    questions = f.table("embeddings").filter(F.col("vec_id") % 20 == 0).select(
        F.col("vec_id").alias("question_id"), F.col("embedding").alias("question")
    )
    names = dict(key="vec_id", vector="embedding", query_key="question_id", query_vector="question")
    found = hyperplanes.nearest_approximate(f.table("embeddings"), questions, 5, **names)
    exact = vectors.nearest_batch(f.table("embeddings"), questions, 5, **names)
    share = hyperplanes.recall(found, exact, "question_id", "vec_id").scalar()
    top = found.filter(F.col("rank") == 1).select("question_id", "vec_id", "similarity")
    return top.withColumn("recalled", share >= 0.9)


register(
    "j15_hyperplanes",
    _approximate,
    """SELECT vec_id AS question_id, vec_id, CAST(1.0 AS DOUBLE) AS similarity, TRUE AS recalled FROM embeddings
       WHERE vec_id % 20 = 0""",
)

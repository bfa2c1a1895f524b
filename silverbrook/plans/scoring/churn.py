"""Churn labels, classifier and customer roll-up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ...contracts import CHURN_SCORES
from ...functions import fixed_values as fixed
from ...functions import rules
from ...operators.keyed import lookup_left_join
from ...operators.quantile import DIGIT_BITS, exact_quantile, order_statistic
from ...operators.ranks import area_under_curve
from ...session import use_checkpoints
from ...sources.tables import staged
from .features import CATEGORIES, CHURN_FEATURES, assemble, fit_codes

# The published model's parameters.
TREES, DEPTH, LEARNING_RATE, ROW_SHARE, COLUMN_SHARE, SEED = 200, 5, 0.05, 0.8, "0.8", 42
TEST_SHARE = 0.2
MODEL_NAME = "gradient_boosted_trees"
KEYS = ("booking_id", "car_id", "payment_id")
ATTRIBUTES = ["customer_name", "loyalty_tier", "points_tier", "is_high_value_customer"]
CHURN_CATEGORIES = [c for c in CATEGORIES if c != "insurer_type"]


def behaviour(mean_payment: Column) -> Column:
    """Low tier, small payment and not a high-value customer."""
    low_tier = F.lower("loyalty_tier").isin(*fixed.CHURN_LOW_TIERS)
    small = F.col("payment_amount") < mean_payment * fixed.CHURN_LOW_PAYMENT_SHARE
    return rules.flag(low_tier) & rules.flag(small) & ~rules.flag(F.col("is_high_value_customer"))


def label_churn(serving: DataFrame, as_of: Column) -> DataFrame:
    """Churned if absent longer than the data-driven threshold, or by behaviour.

    One aggregate a customer, written once, answers everything but the labels themselves: the threshold is a quantile of
    its days weighted by its rows, the mean payment a quotient of its sums, and its rows tell hot customers.
    """
    cents = F.rint(F.col("payment_amount") * 100).cast("long")
    customers = serving.groupBy("customer_id").agg(
        F.max("booking_date").alias("last_booking_date"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum(cents).alias("_cents"),
        F.count("payment_amount").alias("_paid"),
    )
    customers = staged(customers, "churn-customers")
    gap = F.coalesce(F.date_diff(as_of, F.col("last_booking_date")), F.lit(fixed.UNSEEN_DAYS))
    # Rows without a customer have no last booking.
    days = F.when(F.col("customer_id").isNotNull(), gap).otherwise(fixed.UNSEEN_DAYS)
    cut = F.percentile(days, F.lit(fixed.CHURN_RECENCY_QUANTILE), F.col("_rows"))
    threshold = F.greatest(F.lit(fixed.CHURN_INACTIVE_DAYS), F.floor(cut).cast("int"))
    mean = F.sum("_cents") / F.lit(100.0) / F.sum("_paid")
    cuts = customers.agg(F.struct(threshold.alias("t"), mean.alias("mean"))).scalar()

    unique = customers.filter(F.col("customer_id").isNotNull()).select("customer_id", "last_booking_date")
    recent = lookup_left_join(serving, unique, ["customer_id"], counted=customers.select("customer_id", "_rows"))
    framed = recent.withColumns({"days_since_last_booking": gap, "_cuts": cuts})
    absent = F.col("days_since_last_booking") > F.col("_cuts.t")
    by_behaviour = behaviour(F.col("_cuts.mean"))
    return framed.withColumns(
        {"behaviour_label": by_behaviour.cast("int"), "churn_label": (absent | by_behaviour).cast("int")}
    ).drop("_cuts")


def both_classes(labelled: DataFrame) -> DataFrame:
    """Where one class is missing, label by behaviour, and failing that by small payments.

    One aggregate row decides; the column is recomputed, not the data.
    """
    spread = labelled.agg(
        F.min("churn_label"), F.max("churn_label"), F.min("behaviour_label"), F.max("behaviour_label")
    ).first()
    if spread[0] is None or spread[0] != spread[1]:
        return labelled
    if spread[2] != spread[3]:
        return labelled.withColumn("churn_label", F.col("behaviour_label"))
    cut = exact_quantile(labelled, "payment_amount", fixed.CHURN_RECENCY_QUANTILE)
    return labelled.withColumn("churn_label", rules.flag(F.col("payment_amount") < F.lit(cut)).cast("int"))


def split(labelled: DataFrame, keys: Sequence[str] = KEYS, test_share: float = TEST_SHARE, seed: int = SEED):
    """Train and test by key hash, stratified: of each class exactly ``test_share`` of the rows, rounded.

    The rows with the smallest hashes of their class are held out. Leading digits of the hashes are counted for all
    classes at once, and only hashes with the digits of their class's cut are counted one by one; only rows that tie at
    the cut, copies of one key, are numbered. No row is shuffled but those.
    """
    digest = F.xxhash64(*keys, F.lit(seed))
    hashed = labelled.select("churn_label", digest.alias("_h"))
    head = F.shiftright("_h", 64 - DIGIT_BITS)  # signed, so its order is that of the hashes
    heads = staged(hashed.groupBy("churn_label", head.alias("_head")).agg(F.count(F.lit(1)).alias("n")), "split-heads")
    sizes = {r[0]: r[1] for r in heads.groupBy("churn_label").agg(F.sum("n")).collect()}
    wanted = {label: int(n * test_share + 0.5) for label, n in sizes.items()}
    # At most 65,536 leading digits a class.
    upto = F.sum("n").over(Window.partitionBy("churn_label").orderBy("_head"))
    placed = heads.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("n"))
    at_cut = [
        F.col("churn_label").eqNullSafe(F.lit(label)) & (F.col("_before") < n) & (F.col("_upto") >= n)
        for label, n in wanted.items()
        if n
    ]
    found = placed.filter(reduce(or_, at_cut, F.lit(False))).collect()
    near = [F.col("churn_label").eqNullSafe(F.lit(r["churn_label"])) & (head == F.lit(r["_head"])) for r in found]
    counted = staged(
        hashed.filter(reduce(or_, near, F.lit(False)))
        .groupBy("churn_label", F.col("_h").alias("key"))
        .agg(F.count(F.lit(1)).alias("n")),
        "split-hashes",
    )
    rows = labelled.withColumn("_h", digest)
    held = kept = F.lit(False)
    tied = []
    for label, n in wanted.items():
        own = F.col("churn_label").eqNullSafe(F.lit(label))
        if n == 0:
            kept = kept | own
            continue
        before = next(r["_before"] for r in found if r["churn_label"] == label)
        values = counted.filter(own)
        cut = order_statistic(values, n - before - 1)
        below, at = (before + (values.filter(c).agg(F.sum("n")).first()[0] or 0) for c in (f"key < {cut}", f"key = {cut}"))
        at -= before
        whole = below + at == n
        held = held | (own & ((F.col("_h") <= cut) if whole else (F.col("_h") < cut)))
        kept = kept | (own & (F.col("_h") > cut))
        if not whole:
            order = Window.partitionBy("_h").orderBy(*keys)
            tied.append((rows.filter(own & (F.col("_h") == cut)).withColumn("_r", F.row_number().over(order)), n - below))
    test, train = rows.filter(held), rows.filter(kept)
    for ties, n in tied:
        test = test.unionByName(ties.filter(F.col("_r") <= n).drop("_r"))
        train = train.unionByName(ties.filter(F.col("_r") > n).drop("_r"))
    return (labelled, labelled) if not sizes else (train.drop("_h"), test.drop("_h"))


def fit(
    train: DataFrame, *, trees: int = TREES, depth: int = DEPTH, seed: int = SEED
) -> GBTClassificationModel:
    """Boosted trees with the minority class weighted up."""
    use_checkpoints(train.sparkSession)
    rate = train.agg(F.avg("churn_label")).scalar()
    weighted = train.withColumn("_rate", rate).select(
        "features",
        F.col("churn_label").cast("double").alias("label"),
        F.when(F.col("churn_label") == 1, (1 - F.col("_rate")) / F.col("_rate")).otherwise(1.0).alias("weight"),
    )
    estimator = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=trees,
        maxDepth=depth,
        stepSize=LEARNING_RATE,
        subsamplingRate=ROW_SHARE,
        featureSubsetStrategy=COLUMN_SHARE,
        checkpointInterval=10,
        seed=seed,
    )
    return estimator.fit(weighted)


def hold_out_scores(model: GBTClassificationModel, test: DataFrame) -> DataFrame:
    """``churn_probability, churn_label`` of held-out rows, written once."""
    return staged(score(model, test).select("churn_probability", "churn_label"), "hold-out")


def auc(scored: DataFrame) -> DataFrame:
    """``tested, auc`` of scored rows, exact."""
    return area_under_curve(scored, "churn_probability", "churn_label")


def score(model: GBTClassificationModel, featured: DataFrame) -> DataFrame:
    scored = model.transform(featured)
    probability = vector_to_array("probability")[1]
    return scored.withColumn("churn_probability", probability).drop("rawPrediction", "probability", "prediction")


def roll_up(scored: DataFrame, model_auc: float | None = None) -> DataFrame:
    """A row per customer with the highest probability over the customer's rows.

    Attributes are constant within a customer after silver; the smallest is taken should they differ.
    """
    grouped = scored.groupBy("customer_id").agg(
        F.max("churn_probability").alias("churn_probability"), *[F.min(a).alias(a) for a in ATTRIBUTES]
    )
    risk = rules.churn_risk_label(F.col("churn_probability"))
    return grouped.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        *ATTRIBUTES,
        "churn_probability",
        risk.alias("churn_risk"),
        F.lit(model_auc).cast("double").alias("model_auc"),
        F.lit(MODEL_NAME).alias("model_name"),
    )


def training_frame(serving: DataFrame, as_of: Column) -> DataFrame:
    """Labelled rows with features, the columns later steps read written once as Parquet.

    The vectors are written too: fitting alone passes over them four times, then they are held out and scored.
    """
    labelled = label_churn(serving, as_of)
    needed = dict.fromkeys([*KEYS, "customer_id", *ATTRIBUTES, *CHURN_FEATURES, "behaviour_label", "churn_label"])
    labelled = both_classes(staged(labelled.select(*[c for c in needed if c in labelled.columns]), "labelled"))
    read = [c for c in CHURN_CATEGORIES if c in CHURN_FEATURES]
    featured = assemble(labelled, CHURN_FEATURES, fit_codes(labelled, read), read)
    kept = dict.fromkeys([*KEYS, "customer_id", *ATTRIBUTES, "behaviour_label", "churn_label", "features"])
    return staged(featured.select(*[c for c in kept if c in featured.columns]), "featured")


def predict_churn(serving: DataFrame, as_of: Column, *, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """The churn score table of a serving frame: label, split, fit, score all rows, roll up."""
    featured = training_frame(serving, as_of)
    train, test = split(featured)
    model = fit(train, trees=trees, depth=depth)
    area = auc(hold_out_scores(model, test)).first().auc
    result = roll_up(score(model, featured), area)
    return result.select(*[c for c in CHURN_SCORES.columns if c in result.columns])

"""Isolation-forest anomaly scores.

A forest needs only ``trees x 256`` sampled rows however large the table is. Rows are sampled by a hash of
their own key, so the sample does not depend on partitioning; one task grows one tree; the grown forest
is a few megabytes at most and is sent to the tasks that score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...contracts import FRAUD_SCORES
from ...functions import rules
from ...operators.quantile import exact_quantile
from ...operators.series import min_max_risk
from ...sources.tables import staged
from .features import CATEGORIES, FRAUD_FEATURES, assemble, fit_codes

# The published model's parameters.
TREES, SAMPLE_ROWS, CONTAMINATION, SEED = 200, 256, 0.05, 42
# Scores times this are whole numbers: they lie in [-1, 0] and carry 53 bits.
SCORE_SCALE = 1 << 60
MODEL_NAME = "isolation_forest"
NODE_DDL = "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"
EULER = 0.5772156649


def row_hash(keys: Sequence[str], seed: int) -> Column:
    """A uniform number in [0, 1) from the row's key."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(seed)), 11) / F.lit(float(1 << 53))


def tree_samples(df: DataFrame, keys: Sequence[str], trees: int, rows: int, seed: int = SEED) -> DataFrame:
    """About ``1.25 * rows`` rows for each tree, drawn from the whole table; each tree's task cuts them to ``rows``.

    A row's hash says how often it is drawn, so that draws meet their expected number over the true row count, and
    by which trees, a run of consecutive ones; in a small table every tree draws every row. Copies of a row share
    its hash and are combined, map-side first.
    """
    share = F.lit(1.25 * rows * trees) / F.greatest(df.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    drawn = df.withColumn("_share", F.least(share, F.lit(float(trees))))
    times = F.floor("_share") + (row_hash(keys, seed) < F.col("_share") - F.floor("_share")).cast("long")
    drawn = drawn.withColumn("_times", times).filter(F.col("_times") > 0)
    drawn = drawn.groupBy(*keys).agg(F.max("x").alias("x"), F.max("_times").alias("_times"))
    first = F.pmod(F.xxhash64(*keys, F.lit(seed + 1)), F.lit(trees))
    drawn = drawn.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)))
    drawn = drawn.withColumn("tree", ((first + F.col("_i")) % trees).cast("int"))
    return drawn.withColumn("draw", row_hash([*keys, "tree"], seed)).drop("_times", "_i")


def fit_forest(
    df: DataFrame, keys: Sequence[str], trees: int = TREES, rows: int = SAMPLE_ROWS, seed: int = SEED
) -> DataFrame:
    """Grow the forest: one row per tree node (``NODE_DDL``). ``df`` has a ``features`` vector."""
    narrow = df.select(*keys, vector_to_array("features").alias("x"))
    samples = tree_samples(narrow, keys, trees, rows, seed)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        chosen = pdf.sort_values("draw", kind="stable").head(rows)
        return _grow(np.stack(chosen["x"].to_numpy()), tree, np.random.default_rng([seed, tree]))

    return samples.select("tree", "draw", "x").groupBy("tree").applyInPandas(grow, NODE_DDL)


def _grow(x: np.ndarray, tree: int, rng: np.random.Generator) -> pd.DataFrame:
    """Random splits on random features until rows are alone or the depth limit is met."""
    limit = max(1, math.ceil(math.log2(max(len(x), 2))))
    nodes: list[list] = []
    pending = [(np.arange(len(x)), 0, None, None)]
    while pending:
        members, depth, parent, side = pending.pop()
        node = len(nodes)
        if parent is not None:
            nodes[parent][side] = node
        block = x[members]
        low, high = block.min(axis=0), block.max(axis=0)
        splittable = np.flatnonzero(high > low)
        nodes.append([tree, node, -1, 0.0, -1, -1, len(members), depth])
        if depth >= limit or len(members) < 2 or not len(splittable):
            continue
        feature = int(rng.choice(splittable))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = block[:, feature] <= cut
        nodes[node][2], nodes[node][3] = feature, cut
        pending += [(members[~goes_left], depth + 1, node, 5), (members[goes_left], depth + 1, node, 4)]
    names = [c.split()[0] for c in NODE_DDL.split(", ")]
    return pd.DataFrame(nodes, columns=names)


def _expected_depth(size: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of ``size`` rows."""
    n = np.maximum(size.astype("float64"), 1.0)
    big = np.maximum(n, 3.0)
    value = 2 * (np.log(big - 1) + EULER) - 2 * (big - 1) / big
    return np.where(n > 2, value, np.where(n > 1, 1.0, 0.0))


class Forest:
    """Node arrays of all trees; at most ``trees x 511`` entries each.

    A leaf leads to itself, so every row takes the same number of steps and none is asked whether it has arrived.
    """

    def __init__(self, nodes: pd.DataFrame):
        self.trees = int(nodes["tree"].max()) + 1
        self.width = int(nodes["node"].max()) + 1
        at = nodes["tree"].to_numpy().astype("int64") * self.width + nodes["node"].to_numpy()

        def fill(values: np.ndarray, dtype: str) -> np.ndarray:
            table = np.zeros(self.trees * self.width, dtype)
            table[at] = values
            return table

        leaf = nodes["feature"].to_numpy() < 0
        self.feature = fill(np.where(leaf, 0, nodes["feature"]), "int64")
        self.threshold = fill(nodes["threshold"].to_numpy(), "float64")
        # The next node at twice a node, if its feature is at most the threshold, and one further, if not.
        self.next = np.zeros(2 * self.trees * self.width, "int64")
        base = nodes["tree"].to_numpy().astype("int64") * self.width
        for side, column in enumerate(("left", "right")):
            self.next[2 * at + side] = np.where(leaf, at, base + nodes[column].to_numpy())
        depth, size = fill(nodes["depth"].to_numpy(), "float64"), fill(nodes["size"].to_numpy(), "float64")
        self.length = depth + _expected_depth(size)
        self.height = int(nodes["depth"].max())
        self.norm = float(_expected_depth(np.array([size[:: self.width].max()]))[0]) or 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Minus the anomaly score, as published: near -1 is unusual, near -0.5 ordinary."""
        total = np.zeros(len(x))
        start = np.arange(len(x), dtype="int64") * x.shape[1]
        flat = np.ascontiguousarray(x).reshape(-1)
        for t in range(self.trees):
            node = np.full(len(x), t * self.width, "int64")
            for _ in range(self.height):
                value = flat.take(start + self.feature.take(node))
                node = self.next.take(2 * node + ~(value <= self.threshold.take(node)))
            total += self.length.take(node)
        return -np.exp2(-total / self.trees / self.norm)


def score_rows(df: DataFrame, forest_nodes: DataFrame) -> DataFrame:
    """Add ``anomaly_score`` to every row, batch by batch."""
    forest = Forest(forest_nodes.toPandas())

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(forest.score(np.stack(batch.to_numpy())) if len(batch) else [], dtype="float64")

    score = F.pandas_udf(run, "double")
    return df.withColumn("anomaly_score", score(vector_to_array("features")))


def label_scores(scored: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """Flag scores below the exact quantile of the lowest share, scale to 0-100 and band."""
    cut = exact_quantile(scored, "anomaly_score", contamination, SCORE_SCALE)
    flagged = scored.withColumn("is_fraud", F.coalesce(F.col("anomaly_score") < F.lit(cut), F.lit(False)).cast("int"))
    scaled = min_max_risk(flagged, "anomaly_score", "fraud_risk_score")
    return scaled.withColumn("risk_label", rules.fraud_risk_label(F.col("fraud_risk_score")))


def detect(
    serving: DataFrame, keys: Sequence[str] = ("booking_id", "car_id", "payment_id"), *, trees: int = TREES
) -> DataFrame:
    """The fraud score table of a serving frame."""
    read = [c for c in CATEGORIES if c in FRAUD_FEATURES]
    featured = assemble(serving, FRAUD_FEATURES, fit_codes(serving, read), read)
    # Scores are read three times (cut, bounds, result); they are worked out once.
    wanted = [c for c in FRAUD_SCORES.columns if c in featured.columns]
    scored = score_rows(featured, fit_forest(featured, list(keys), trees)).select(*wanted, "anomaly_score")
    scored = label_scores(staged(scored, "anomaly-scores"))
    scored = scored.withColumns({"model_name": F.lit(MODEL_NAME), "pickup_hour": rules.or_zero(F.col("pickup_hour"))})
    return scored.select(*[c for c in FRAUD_SCORES.columns if c in scored.columns])

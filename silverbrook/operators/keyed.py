"""De-duplication, skew-safe joins and key lookups.

Any single key may hold a large share of all rows, so nothing here gathers a key's rows into one task:
survivors are picked by map-side combined aggregates, counts are aggregated before they are joined back,
and fan-out joins split a hot key over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A task of a split join makes about so many rows, so a key is cut once its rows, or the product of its rows on all
# sides, are more.
HOT_ROWS = 2_000_000
# A table of hot keys is broadcast up to so many entries, counted first; beyond that it is joined like any other.
HOT_KEYS = 500_000
# Rows without a key meet nothing and are spread over so many places.
NULL_PLACES = 4096


def newest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per key: the largest by ``newest_first``, ties broken by the rest of the row."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    order = F.struct(*[F.col(c) for c in newest_first], *[F.col(c) for c in others if c not in newest_first])
    picked = df.groupBy(*keys).agg(F.max(order).alias("row"))
    return picked.select(*[F.col(c) if c in keys else F.col("row")[c].alias(c) for c in df.columns])


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_key_count(
    df: DataFrame, keys: Sequence[str], name: str, counted: DataFrame | None = None
) -> DataFrame:
    """Attach the number of rows sharing a key: combine map-side, then join the small result back.

    ``counted`` is the frame whose rows are counted, if it is not ``df`` itself.
    """
    return lookup_left_join(df, key_counts(df if counted is None else counted, keys, name), keys)


def lookup_left_join(
    df: DataFrame,
    unique: DataFrame,
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a table with one row per key, balanced when one key owns much of ``df``.

    Adaptive execution does not split a join whose lookup side comes straight out of an aggregate, which
    is the usual case here. Rows of a hot key are therefore spread over slices and its single lookup row
    is copied to each of them; each row still meets exactly one lookup row. Rows without a whole key are
    spread over places where no lookup row is. Keys, null ones too, are counted first, with map-side combination;
    where none is hot, the join is a plain one, with all columns pruned and filters pushed down. ``counted`` holds the
    rows of each key of ``df`` in ``_rows`` where the caller knows them already.
    """
    keys = list(keys)
    counts = (key_counts(df, keys, "_rows") if counted is None else counted).filter(F.col("_rows") > hot_rows)
    hot = _checked(counts.select(*keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_slices")))
    if hot is None:
        return df.join(unique, keys, "left")
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    spread = df.withColumn("_spread", _spread(df)).join(hot, keys, "left")
    own = (F.col("_spread") % slices).cast("int")
    copies = unique.join(hot, keys, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    copies = copies.drop("_slices")
    spread = spread.withColumn("_slice", _placed(own, keys)).select(*df.columns, "_slice")
    return spread.join(copies, [*keys, "_slice"], "left").drop("_slice")


def _placed(own: Column, keys: Sequence[str]) -> Column:
    """The slice of a row, or for one without a whole key a place below zero, where nothing is looked up."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return F.when(known, own).otherwise((-1 - F.col("_spread") % NULL_PLACES).cast("int"))


def _checked(hot: DataFrame) -> DataFrame | None:
    """None where no key is hot, the null one included; else the table of hot keys, broadcast if counted and small.

    Written first: it is counted here and then read by every side of its join, and costs an aggregate over all of them.
    """
    from ..sources.tables import staged

    hot = staged(hot, "hot-keys")
    n = hot.limit(HOT_KEYS + 1).count()
    return None if n == 0 else F.broadcast(hot) if n <= HOT_KEYS else hot


def _spread(df: DataFrame) -> Column:
    """A number to slice rows by: the content hash spreads distinct rows, the partition id identical copies.

    A task that is run again computes the same values.
    """
    return F.abs(F.xxhash64(*df.columns) % (1 << 30)) + F.spark_partition_id()


def fan_out_left_join(
    left: DataFrame,
    children: Sequence[DataFrame],
    key: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``left`` left-joined to each many-row child on ``key``, balanced by the rows a key makes.

    A key's result is the product of its rows on every side, the left one included, so the product decides: keys
    beyond ``hot_rows`` are cut. Each side of such a key falls into slices, and a cell is one combination of
    slices. A row goes to all cells of its own slice, so every combination of rows meets in exactly one cell, a
    cell makes about ``hot_rows`` rows, and all joins share one partitioning by ``(key, cell)``. A cell that
    misses a child its key does have is not a result and is dropped. Rows without a key are spread likewise. Keys
    are counted in one aggregate over all sides; where none is hot, the joins are plain ones.
    """
    return cell_join(left, children, key, hot_slices([left, *children], key, hot_rows))


def hot_slices(sides: Sequence[DataFrame], key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The written table of hot keys that ``cell_join`` takes; None where no key is hot."""
    return _checked(_hot_slices(sides, key, hot_rows))


def cell_join(left: DataFrame, children: Sequence[DataFrame], key: str, hot: DataFrame | None) -> DataFrame:
    """``fan_out_left_join`` with the hot keys of just these sides, counted before."""
    if hot is None:
        return reduce(lambda frame, child: frame.join(child, key, "left"), children, left)
    sides = [left, *children]
    joined = _to_cells(left, 0, len(sides), hot, key)
    for i, child in enumerate(children, 1):
        joined = joined.join(_to_cells(child.filter(F.col(key).isNotNull()), i, len(sides), hot, key), [key, "_cell"], "left")
    has = [F.coalesce(F.col(f"_has{i}"), F.lit(False)) for i in range(1, len(sides))]
    hits = [F.coalesce(F.col(f"_hit{i}"), F.lit(False)) for i in range(1, len(sides))]
    joined = joined.filter(reduce(lambda a, b: a & b, [~has_ | hit for has_, hit in zip(has, hits, strict=True)]))
    wanted = left.columns + [c for child in children for c in child.columns if c != key]
    return joined.select(*wanted)


def _hot_slices(sides: Sequence[DataFrame], key: str, hot_rows: int) -> DataFrame:
    """For keys whose product of rows is beyond ``hot_rows``: slices per side, and which sides have the key."""
    tagged = reduce(
        DataFrame.unionByName,
        [
            (s.filter(F.col(key).isNotNull()) if i else s).select(F.col(key), F.lit(i).alias("_side"))
            for i, s in enumerate(sides)
        ],
    )
    n = len(sides)
    rows = [F.col(f"_rows{i}") for i in range(n)]
    counts = tagged.groupBy(key).agg(*[F.count_if(F.col("_side") == i).alias(f"_rows{i}") for i in range(n)])
    made = [F.greatest(r, F.lit(1)).cast("double") for r in rows]
    product = reduce(lambda a, b: a * b, made)
    # A row goes to every slice of the other sides, so the larger side is cut and no more than a cell needs: from the
    # smallest side on, each takes its even share of the rows a cell may still make and leaves what it does not need.
    order = F.array_sort(F.array(*[F.struct(m.alias("rows"), F.lit(i).alias("side")) for i, m in enumerate(made)]))
    room, cuts = F.lit(float(hot_rows)), []
    for place in range(n):
        size, share = order[place]["rows"], F.pow(room, F.lit(1.0 / (n - place)))
        cut = F.greatest(F.ceil(size / share - F.lit(1e-9)).cast("int"), F.lit(1))
        cuts.append(F.struct(order[place]["side"].alias("side"), cut.alias("cut")))
        room = room * cut / size
    by_side = F.map_from_entries(F.array(*cuts))
    slices = [by_side[i].alias(f"_slices{i}") for i in range(n)]
    return counts.filter((product > hot_rows) & (rows[0] > 0)).select(
        key, *slices, *[(r > 0).alias(f"_has{i}") for i, r in enumerate(rows)]
    )


def _to_cells(side: DataFrame, index: int, n: int, hot: DataFrame, key: str) -> DataFrame:
    """Rows of a side with the cells they belong to: own slice fixed, every slice of the other sides."""
    frame = side.withColumn("_spread", _spread(side))
    marks = [F.lit(True).alias(f"_hit{index}")] if index else []
    slices = [F.coalesce(F.col(f"_slices{i}"), F.lit(1)) for i in range(n)]
    cell, step = F.lit(0), F.lit(1)
    frame = frame.join(hot, key, "left")
    for i in range(n):
        if i == index:
            place = (F.col("_spread") % slices[index]).cast("int")
        else:
            frame = frame.withColumn(f"_at{i}", F.explode(F.sequence(F.lit(0), slices[i] - 1)))
            place = F.col(f"_at{i}")
        cell, step = cell + place * step, step * slices[i]
    has = [F.col(f"_has{i}") for i in range(1, n)] if index == 0 else []
    return frame.select(*side.columns, _placed(cell.cast("int"), [key]).alias("_cell"), *has, *marks)


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    repeated = key_counts(df, keys).filter(F.col("n_rows") > 1).select(*keys, F.lit(True).alias("_repeated"))
    return lookup_left_join(df, repeated, keys).filter("_repeated").drop("_repeated")


def not_in(value: Column, members: Sequence[object]) -> Column:
    """``NOT IN`` with SQL's three-valued logic: null never qualifies."""
    return ~value.isin(*members)


def days_since_last(df: DataFrame, key: str, day: str, as_of: Column, missing: int) -> DataFrame:
    """Days from each key's latest date to ``as_of``, attached to every row."""
    latest = df.groupBy(key).agg(F.max(day).alias("last_booking_date"))
    gap = F.coalesce(F.date_diff(as_of, F.col("last_booking_date")), F.lit(missing))
    return lookup_left_join(df, latest, [key]).withColumn("days_since_last_booking", gap)


def latest_run_rows(records: DataFrame, runs: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """Rows of the most recent run; runs sharing a timestamp resolve to the larger id."""
    latest = runs.agg(F.max(F.struct(F.col(created_at), F.col(run_id))).alias("run")).select(f"run.{run_id}")
    return records.filter(F.col(run_id) == latest.scalar())

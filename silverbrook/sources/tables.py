"""Lake tables on plain partitioned files, or Delta where it is installed.

A keyed table is partitioned by a hash of its key. An upsert reads the partitions its source touches, merges, and
replaces those partitions with a dynamic partition overwrite; the others are neither read nor written. Merging is by
key, so an upsert that was cut short is mended by running it again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import merged, merged_newest, unique_source
from ..session import fresh_path

BUCKETS = 64
BUCKET = "_bucket_of_"
# Tables and what is passed on by files: half the room of the default, for the same time.
PACKED = {"compression": "zstd"}


def delta_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
        return True
    except Exception:
        return False


def balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows gathered by column values, where adaptive execution may cut a large value into several tasks."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here and lost executors cost nothing."""
    path = fresh_path(df.sparkSession, label)
    df.write.options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- plain tables ------------------------------------------------------------------------------------------

def read_table(spark: SparkSession, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None) -> DataFrame:
    """A table by path, or its projection; the hash a keyed table is partitioned by is not shown."""
    df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df.drop(*[c for c in df.columns if c.startswith(BUCKET)])


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if the path holds a table."""
    fs, root = _fs(spark, path)
    return fs.exists(root)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "append") -> None:
    """Hive-style partitioned write.

    Rows of a partition value are brought together first; the rebalance lets adaptive execution cut a
    value that holds much of the data into several tasks and files.
    """
    balanced(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_slice(df: DataFrame, path: str, partition_col: str) -> None:
    """Replace only the partition values present in ``df``."""
    (
        balanced(df, [partition_col])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def absent_rows(target: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Rows whose key the target lacks, one per key."""
    return unique_source(df, [key]).join(target.select(key), key, "left_anti")


def append_if_absent(spark: SparkSession, df: DataFrame, path: str, key: str) -> None:
    """Append rows with a new key; the first write creates the table."""
    if table_exists(spark, path):
        df = absent_rows(read_table(spark, path), df, key)
    else:
        df = unique_source(df, [key])
    append_rows(df, path)


def write_report(df: DataFrame, path: str) -> None:
    """A validation report as JSON lines."""
    df.write.mode("overwrite").json(path)


def save_model(model, root: str, name: str, version: str) -> list[str]:
    """A fitted model under its version and under ``latest``."""
    paths = [f"{root.rstrip('/')}/{name}/{v}" for v in (version, "latest")]
    for path in paths:
        model.write().overwrite().save(path)
    return paths


# -- whole and keyed tables ------------------------------------------------------------------------------------

def publish(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    plain: Sequence[str] = (),
) -> str:
    """Write ``df`` as the whole table. It may be computed from the table's present rows: they are read first.

    ``plain`` names columns whose texts differ so much that a Parquet dictionary costs more than it saves.
    """
    if table_exists(spark, path):
        df = staged(df, "publish")
    writer = (balanced(df, partition_by) if partition_by else df).write.mode("overwrite").format(fmt)
    writer = (writer.options(**PACKED) if fmt == "parquet" else writer).options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain})
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return path


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    newest_first: Sequence[str] = (),
    fmt: str = "parquet",
    buckets: int = BUCKETS,
) -> None:
    """Create on the first run, update and insert by key afterwards.

    Of the source's rows of a key one counts, so replayed input changes nothing. The table is partitioned by a
    hash of the key, so a key never changes its partition, and only partitions that hold a key of the source are read
    and replaced. ``buckets`` belongs to the table; another number, or other keys, than it was made with is an error.
    A source without rows changes nothing and creates nothing.

    Rows of the table and of the source meet once, by key: one aggregate makes the source unique, lets it win over the
    table and leaves each bucket's rows together for the write.
    """
    if fmt == "delta" and delta_available(spark):
        _delta_upsert(spark, unique_source(source, keys, newest_first), path, keys)
        return
    placed, target, bucket = _placed(spark, source, path, keys, fmt, buckets)
    if placed is None:
        return
    with _buckets_together(spark, buckets):
        rows = merged_newest(target, placed, keys, newest_first).withColumn(bucket, _bucket(keys, buckets))
        _replace_buckets(rows, path, bucket, fmt)


def replace_groups(
    spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet", buckets: int = BUCKETS
) -> None:
    """Replace all rows of each key of ``source`` by its rows there, however many; other keys stay.

    For tables whose rows depend on a group as a whole, such as a booking's cars and payments: rows that a group no
    longer has go. The table is laid out, and a source without rows treated, as by ``upsert``.
    """
    _replace_keys(spark, source, path, keys, fmt, buckets)


def _replace_keys(
    spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], fmt: str, buckets: int
) -> None:
    placed, target, bucket = _placed(spark, source, path, keys, fmt, buckets)
    if placed is not None:
        rows = placed if target is None else merged(target, placed, keys)
        _replace_buckets(balanced(rows.withColumn(bucket, _bucket(keys, buckets)), [bucket]), path, bucket, fmt)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row. It is the remainder of the hash by which a shuffle by key deals out its partitions."""
    return F.pmod(F.hash(*keys), F.lit(buckets)).cast("int")


def _placed(
    spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], fmt: str, buckets: int
) -> tuple[DataFrame | None, DataFrame | None, str]:
    """The written source, None without rows; the table's rows of the buckets it touches, None without a table; the
    name of the bucket column."""
    # The name keeps tables made with other keys or another number of buckets apart.
    bucket = f"{BUCKET}{buckets}_by_{'_'.join(keys)}"
    # The source is read for its buckets and its rows: it is worked out once.
    placed = staged(source, "upsert")
    # At most one row a bucket.
    touched = [r[0] for r in placed.select(_bucket(keys, buckets)).distinct().collect()]
    target = None
    if table_exists(spark, path):
        target = spark.read.format(fmt).load(path)
        if bucket not in target.columns:
            raise ValueError(f"{path} is not partitioned by {bucket}")
        # A few rows tell a table whose buckets were dealt by another hash: its keys would come to stand twice.
        if not target.limit(32).filter(F.col(bucket) != _bucket(keys, buckets)).isEmpty():
            raise ValueError(f"{path} is not partitioned by the hash of {bucket}: write it anew")
        # A dynamic overwrite may read what it replaces: partitions are exchanged when all are written.
        target = target.filter(F.col(bucket).isin(touched)).drop(bucket)
    return (placed if touched else None), target, bucket


def _replace_buckets(rows: DataFrame, path: str, bucket: str, fmt: str) -> None:
    writer = rows.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
    (writer.options(**PACKED) if fmt == "parquet" else writer).partitionBy(bucket).save(path)


@contextmanager
def _buckets_together(spark: SparkSession, buckets: int) -> Iterator[None]:
    """Shuffles by key into a multiple of ``buckets`` partitions: then a partition's rows are all of one bucket.

    So a bucket gets as many files as its share of the partitions, without another shuffle before the write.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(-(-int(before) // buckets) * buckets))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _delta_upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str]):
    from delta.tables import DeltaTable

    if not DeltaTable.isDeltaTable(spark, path):
        source.write.format("delta").mode("overwrite").save(path)
        return
    match = " AND ".join(f"target.`{k}` <=> source.`{k}`" for k in keys)
    merge = DeltaTable.forPath(spark, path).alias("target").merge(source.alias("source"), match)
    merge.whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()


# -- serving database -----------------------------------------------------------------------------------------------

def jdbc_write_options(url: str, table: str, user: str, password: str, driver: str) -> dict[str, str]:
    """Truncate-and-insert that keeps the table's own definition."""
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver, "truncate": "true"}


def write_jdbc(df: DataFrame, options: dict[str, str], connections: int = 16) -> None:
    """Replace the serving table's rows, over a bounded number of connections.

    The exchange keeps the work before it as parallel as it was; a coalesce would squeeze that too.
    """
    df.repartition(connections).write.format("jdbc").options(**options).mode("overwrite").save()


def jdbc_read_options(
    url: str, table: str, partition_column: str, lower: int, upper: int, partitions: int
) -> dict[str, str]:
    """A range-partitioned database read, so that the table arrives in parallel."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


# -- file system ---------------------------------------------------------------------------------------------------

def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    root = _path(spark, path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root

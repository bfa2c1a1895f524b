"""Upserts, versioned tables, slices, contracts and settings."""

import glob
import json

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverbrook import contracts
from silverbrook.catalog import QUERIES
from silverbrook.operators import upsert
from silverbrook.session import Settings, Thresholds, fresh_path, prepare, shared_dir
from silverbrook.sources import tables
from silverbrook.streaming import ingest

from .conftest import values

DDL = "k int, j int, v string"


def _sorted(df):
    return sorted(values(df, *df.columns), key=str)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.integers(0, 6), st.text("ab", max_size=2), max_size=6),
    st.dictionaries(st.integers(0, 6), st.text("cd", max_size=2), max_size=6),
)
def test_merge_is_last_write_wins(spark, target, source):
    frames = [spark.createDataFrame([(k, 0, v) for k, v in d.items()], DDL) for d in (target, source)]
    once = upsert.merged(*frames, ["k"])
    assert {k: v for k, _, v in values(once, "k", "j", "v")} == {**target, **source}
    assert _sorted(upsert.merged(once, frames[1], ["k"])) == _sorted(once)


def test_null_in_composite_key_matches(spark):
    target = spark.createDataFrame([(1, None, "old"), (1, 2, "keep")], DDL)
    source = spark.createDataFrame([(1, None, "new"), (None, None, "add")], DDL)
    got = _sorted(upsert.merged(target, source, ["k", "j"]))
    assert got == sorted([(1, None, "new"), (1, 2, "keep"), (None, None, "add")], key=str)


def test_unique_sides_merge_as_they_are_laid_out(spark):
    prepare(spark)
    target = spark.createDataFrame([(1, None, "old"), (1, 2, "keep"), (None, None, "old"), (2, 2, "same"), (3, 1, None)], DDL)
    source = spark.createDataFrame([(1, None, "new"), (None, None, "new"), (2, 2, "same"), (2, None, "add")], DDL)
    sides = [upsert.unique_source(df.repartition(4, "k"), ["k", "j"]) for df in (target, source)]
    got = upsert.merged(*sides, ["k", "j"], unique=True)
    assert _sorted(got) == _sorted(upsert.merged(target, source, ["k", "j"])) and got.columns == target.columns
    # Both sides stay where their first key has put them.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Exchange hashpartitioning(k" in plan


def test_curated_loads_are_not_shuffled_to_be_merged(spark, sf_dir):
    for name in ("j10_upsert_composite_key", "j11_upsert_curated"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(coalesce" not in plan


def test_duplicate_source_keys_can_be_rejected(spark):
    source = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], DDL)
    with pytest.raises(upsert.DuplicateSourceKeys):
        upsert.reject_duplicates(source, ["k"])
    assert upsert.reject_duplicates(source, ["k", "j"]).count() == 2


def test_upsert_creates_updates_and_replays(spark, folder):
    path = f"{folder}/t"
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], DDL)
    tables.upsert(spark, first, path, ["k"], newest_first=["j"])
    assert _sorted(tables.read_table(spark, path)) == [(1, 2, "b"), (2, 1, "c")]
    for _ in range(2):
        tables.upsert(spark, spark.createDataFrame([(2, 5, "d"), (3, 1, "e")], DDL), path, ["k"])
        assert _sorted(tables.read_table(spark, path)) == [(1, 2, "b"), (2, 5, "d"), (3, 1, "e")]


def test_a_published_table_may_be_computed_from_itself(spark, folder):
    path = f"{folder}/t"
    tables.publish(spark, spark.createDataFrame([(1, 1, "a")], DDL), path)
    more = tables.read_table(spark, path).unionByName(spark.createDataFrame([(2, 2, "b")], DDL))
    tables.publish(spark, more, path)
    assert _sorted(tables.read_table(spark, path)) == [(1, 1, "a"), (2, 2, "b")]


def test_published_ids_take_no_dictionary_and_keep_their_rows(spark, folder):
    rows = [(f"B{i // 3}" if i % 7 else None, "gold" if i % 2 else "", i) for i in range(300)]
    df = spark.createDataFrame(rows, "booking_id string, loyalty_tier string, n int").coalesce(1)
    path = tables.publish(spark, df, f"{folder}/plain", plain=contracts.SERVING_PLAIN)
    assert sorted(tables.read_table(spark, path).collect(), key=lambda r: r.n) == rows
    (part,) = glob.glob(f"{path}/*.parquet")
    chunks = pq.ParquetFile(part).metadata.row_group(0)
    used = {chunks.column(i).path_in_schema: chunks.column(i).has_dictionary_page for i in range(chunks.num_columns)}
    assert not used["booking_id"] and used["loyalty_tier"]


def test_partitioned_table_prunes(spark, folder):
    path = f"{folder}/p"
    df = spark.createDataFrame([(y, m, "x") for y in (2023, 2024) for m in (1, 2)], "y int, m int, v string")
    tables.write_partitioned(df, path, ["y", "m"], mode="overwrite")
    read = tables.read_table(spark, path).filter("y = 2024 AND m = 1")
    assert read.count() == 1
    assert "PartitionFilters: [isnotnull(y" in read._jdf.queryExecution().toString()


def test_replace_slice_leaves_other_slices(spark, folder):
    path = f"{folder}/s"
    ddl = "v int, model_name string"
    tables.replace_slice(spark.createDataFrame([(1, "a"), (2, "b")], ddl), path, "model_name")
    tables.replace_slice(spark.createDataFrame([(3, "b")], ddl), path, "model_name")
    assert sorted(values(tables.read_table(spark, path), "v", "model_name")) == [(1, "a"), (3, "b")]


def test_append_if_absent(spark, folder):
    path = f"{folder}/a"
    ddl = "run string, n int"
    tables.append_if_absent(spark, spark.createDataFrame([("r1", 1)], ddl), path, "run")
    tables.append_if_absent(spark, spark.createDataFrame([("r1", 2), ("r2", 3)], ddl), path, "run")
    assert sorted(values(tables.read_table(spark, path), "run", "n")) == [("r1", 1), ("r2", 3)]


def test_jdbc_options():
    write = tables.jdbc_write_options("jdbc:postgresql://h/d", "t", "u", "p", "drv")
    assert write["truncate"] == "true" and write["dbtable"] == "t"
    read = tables.jdbc_read_options("jdbc:x", "t", "id", 0, 100, 8)
    assert read["numPartitions"] == "8" and read["partitionColumn"] == "id"


# -- contracts -------------------------------------------------------------------------------------------

def test_serving_contract_has_37_columns():
    assert len(contracts.SERVING.columns) == 37
    assert contracts.FAILED_RECORD_COLUMNS[0] == "booking_id" and len(contracts.FAILED_RECORD_COLUMNS) == 17


def test_names_match_struct(spark):
    for contract in (contracts.SERVING, contracts.RUN_STATS, contracts.VALIDATION_RESULTS, contracts.FLAT_RECORD):
        assert contract.columns == contract.struct.fieldNames()


def test_enforce_defaults_stamps_and_rejects(spark):
    df = spark.createDataFrame([("r", "s", None)], "run_id string, stage_name string, status string")
    row = contracts.enforce(df, contracts.RUN_STATS).first()
    assert (row["status"], row["records_processed"], row["started_at"] is not None) == ("SUCCESS", 0, True)
    broken = spark.createDataFrame([(None, "s")], "run_id string, stage_name string")
    with pytest.raises(Exception, match="must not be null"):
        contracts.enforce(broken, contracts.RUN_STATS).collect()


def test_flat_record_breaks_the_nested_contract(spark):
    diff = contracts.schema_diff(spark, contracts.FLAT_RECORD.struct, contracts.schema(contracts.EVENT_DDL))
    missing = {r["field"] for r in diff.filter("change = 'missing'").collect()}
    assert missing == {"customer", "booking_details", "cars", "payments"}
    entry = contracts.schema_log_entry(diff, "bookings", 2, 7).first()
    assert entry["is_compatible"] is False and entry["change_type"] == "UPDATED"
    same = contracts.schema_diff(spark, contracts.FLAT_RECORD.struct, contracts.FLAT_RECORD.struct)
    entry = contracts.schema_log_entry(same, "bookings", 1, 1).first()
    assert entry["is_compatible"] is True and entry["change_type"] == "REGISTERED"


def test_observed_fields(spark):
    messages = spark.createDataFrame([('{"booking_id":"1","extra":1}',), ('{"booking_id":"2"}',)], "value string")
    got = {r["field"]: (r["messages"], r["change"]) for r in contracts.observed_diff(messages, contracts.FLAT_RECORD.struct).collect()}
    assert got["booking_id"] == (2, "same") and got["extra"] == (1, "added") and got["model"] == (0, "missing")


def test_split_valid(spark):
    df = spark.createDataFrame([("1", "a"), ("", "b"), (None, "c")], "booking_id string, v string")
    valid, rejects = contracts.split_valid(df, ["booking_id"])
    assert values(valid, "v") == [("a",)] and sorted(values(rejects, "v")) == [("b",), ("c",)]


# -- settings ------------------------------------------------------------------------------------------------

def test_settings_file(tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"topic": "t", "thresholds": {"sla_seconds": 5}}))
    loaded = Settings.load(str(path))
    assert (loaded.topic, loaded.thresholds.sla_seconds, loaded.thresholds.dq_gate) == ("t", 5, Thresholds().dq_gate)
    path.write_text(json.dumps({"topik": "t"}))
    with pytest.raises(ValueError, match="topik"):
        Settings.load(str(path))
    with pytest.raises(FileNotFoundError):
        Settings.load(str(tmp_path / "absent.json"))


class _Session:
    """A session stub with a configured checkpoint folder, or none."""

    def __init__(self, configured, master):
        self.conf = self.sparkContext = self
        self.configured, self.master, self.applicationId = configured, master, f"app-{configured}-{master}"

    def get(self, key, default=None):
        return self.configured if key == "spark.checkpoint.dir" else default

    def getConf(self):
        return self


def test_shared_dir_follows_the_session():
    assert shared_dir(_Session("/shared/x", "yarn")) == "/shared/x"
    local = _Session(None, "local[2]")
    assert shared_dir(local) == shared_dir(local)
    assert fresh_path(local, "x") != fresh_path(local, "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session(None, "spark://host:7077"))


def test_defaults_may_derive_from_the_row(spark):
    df = spark.createDataFrame([(None, 1)], "a string, b int")
    got = contracts.with_defaults(df, {"a": "x", "c": F.col("b") + 1}).first()
    assert (got["a"], got["c"]) == ("x", 2)


def _bucket_files(spark, path):
    return {f.split("_bucket_of_8_by_k=")[1].split("/")[0]: f for f in tables.read_table(spark, path).inputFiles()}


def test_upsert_rewrites_touched_buckets_only(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(400).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    tables.upsert(spark, rows, path, ["k"], buckets=8)
    before = _bucket_files(spark, path)
    change = spark.createDataFrame([(3, "new"), (1000, "new")], "k bigint, v string")
    tables.upsert(spark, change, path, ["k"], buckets=8)
    after = _bucket_files(spark, path)
    assert len(before) == 8 and 1 <= sum(before[b] != after[b] for b in before) <= 2
    got = dict(values(tables.read_table(spark, path), "k", "v"))
    assert len(got) == 401 and got[3] == got[1000] == "new" and got[4] == "old"
    assert tables.read_table(spark, path).columns == ["k", "v"]
    tables.upsert(spark, change.limit(0), path, ["k"], buckets=8)
    assert _bucket_files(spark, path) == after


def test_an_upsert_cut_short_is_mended_by_the_next(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    tables.upsert(spark, rows, path, ["k"], buckets=8)
    change = rows.withColumn("v", F.lit("new"))
    # Only some of the partitions were replaced before the writer was lost.
    some = spark.read.parquet(path).filter("_bucket_of_8_by_k < 3").withColumn("v", F.lit("new"))
    tables.replace_slice(tables.staged(some, "half"), path, "_bucket_of_8_by_k")
    assert 0 < tables.read_table(spark, path).filter("v = 'new'").count() < 100
    tables.upsert(spark, change, path, ["k"], buckets=8)
    assert sorted(values(tables.read_table(spark, path), "k", "v")) == [(i, "new") for i in range(100)]


def test_a_table_keeps_its_keys_and_buckets(spark, folder):
    path = f"{folder}/t"
    rows = spark.createDataFrame([(1, 1, "a")], DDL)
    tables.upsert(spark, rows.limit(0), path, ["k"])
    assert not tables.table_exists(spark, path)
    tables.upsert(spark, rows, path, ["k"])
    for other in ({"keys": ["j"]}, {"keys": ["k"], "buckets": 8}):
        with pytest.raises(ValueError, match="not partitioned"):
            tables.upsert(spark, rows, path, **other)


def test_the_source_of_an_upsert_is_worked_out_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(50).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    for run in (1, 2):
        tables.upsert(spark, rows.mapInPandas(count, "k bigint, v string"), f"{folder}/t", ["k"], buckets=8)
        assert seen.value == 50 * run
    assert tables.read_table(spark, f"{folder}/t").count() == 50


def test_partitions_of_joins_by_hash_table_are_small(spark):
    conf = prepare(spark).conf
    sizes = {conf.get(f"spark.sql.adaptive.{name}") for name in ("maxShuffledHashJoinLocalMapThreshold", "advisoryPartitionSizeInBytes")}
    assert sizes == {"16MB"}


def test_rows_meet_once_in_an_upsert_and_buckets_have_few_files(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(4000).select((F.col("id") % 2000).alias("k"), F.col("id").cast("string").alias("v"))
    for shift, want in ((0, "3999"), (1, "4000")):
        loaded = rows.withColumn("v", (F.col("v").cast("long") + shift).cast("string")).repartition(8)
        tables.upsert(spark, loaded, path, ["k"], buckets=8)
        got = dict(values(tables.read_table(spark, path), "k", "v"))
        assert len(got) == 2000 and got[1999] == want
    # A partition of the shuffle by key holds rows of one bucket, so tasks do not each write to all of them.
    partitions = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 8) * 8
    assert len(tables.read_table(spark, path).inputFiles()) <= partitions
    both = upsert.merged_newest(spark.read.parquet(path).drop("_bucket_of_8_by_k"), rows, ["k"])
    assert both.count() == 2000
    assert both._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    # A table whose buckets another hash has dealt would get its keys twice.
    odd = spark.read.parquet(path).withColumn("_bucket_of_8_by_k", F.pmod(F.col("k"), F.lit(8)).cast("int"))
    odd.write.partitionBy("_bucket_of_8_by_k").parquet(f"{folder}/odd")
    with pytest.raises(ValueError, match="hash"):
        tables.upsert(spark, rows, f"{folder}/odd", ["k"], buckets=8)


def test_tables_and_messages_are_packed(spark, folder):
    rows = spark.range(3).select(F.col("id").alias("k"))
    tables.publish(spark, rows, f"{folder}/p")
    tables.upsert(spark, rows, f"{folder}/u", ["k"])
    ingest._write_slice(rows, f"{folder}/s", "r", 0)
    for name in ("p", "u", "s/run=r/batch=0"):
        files = spark.read.parquet(f"{folder}/{name}").inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files)

"""Bucketed stores, history lookups, ordered edges, multiset comparison, one-pass verdicts, the table function."""

import glob
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.operators import compare as C
from sluice.operators import history as H
from sluice.operators import ordering as O
from sluice.operators.contracts import BUILT_IN_CONTRACTS
from sluice.plans.ingest import ingest_rows, one_pass_verdicts, replay_equivalence, verdicts_for
from sluice.sources import sinks as S
from sluice.sources.csv import read_governed_csv, register_governed_csv
from sluice.sources.tables import raw_for

SF = "/root/testdata/sf0.001"
RECORD = "contract_id string, contract_version int, source_id string, row_number long, value string"


def _records(spark, files, mark):
    return spark.createDataFrame([("c", 1, f"file-{i}", r, mark) for i in files for r in range(3)], RECORD)


def test_canonical_store_has_few_directories_and_replays_equally(spark, tmp_root):
    path = tmp_root + "/canonical"
    assert S.read_canonical(spark, path, spark.createDataFrame([], RECORD).schema).count() == 0
    S.write_canonical(_records(spark, range(3000), "a"), path, buckets=8)
    assert len(glob.glob(path + "/*/*/bucket=*")) == 8
    before = {d: sorted(glob.glob(d + "/*")) for d in glob.glob(path + "/*/*/bucket=*")}
    S.write_canonical(_records(spark, [5], "b"), path, buckets=8)
    changed = [d for d, files in before.items() if sorted(glob.glob(d + "/*")) != files]
    assert len(changed) == 1  # a replay rewrites the bucket it touches
    got = Counter((r["source_id"] == "file-5", r["value"]) for r in S.read_canonical(spark, path).collect())
    assert got == {(False, "a"): 2999 * 3, (True, "b"): 3}
    S.write_canonical(_records(spark, range(3000), "a"), path, buckets=8)
    assert Counter(r["value"] for r in S.read_canonical(spark, path).collect()) == {"a": 9000}


def test_canonical_store_drops_files_that_have_no_record_any_more(spark, tmp_root):
    path = tmp_root + "/canonical"
    S.write_canonical(_records(spark, [1, 2], "a"), path, buckets=1000)
    gone = spark.createDataFrame([("c", 1, "file-1")], "contract_id string, contract_version int, source_id string")
    S.write_canonical(_records(spark, [2], "b"), path, replaced=gone, buckets=1000)
    assert {(r["source_id"], r["value"]) for r in S.read_canonical(spark, path).collect()} == {("file-2", "b")}


def _events(spark, n, day="2026-01-01"):
    return spark.range(n).select(
        F.concat(F.lit("run-"), (F.col("id") / 4).cast("long").cast("string")).alias("source_id"),
        (F.col("id") % 4).cast("int").alias("seq"), F.lit("RUNNING").alias("target_state"),
        F.lit(day + " 10:00:00").cast("timestamp").alias("event_time"))


def test_lookup_of_ids_prunes_the_log(spark, tmp_root):
    path = tmp_root + "/history"
    H.write_history(_events(spark, 40_000), path, "r1")
    H.write_history(_events(spark, 4_000, "2026-01-02"), path, "r2")
    ids = spark.createDataFrame([(f"run-{i}",) for i in (3, 900, 5000)] + [("none",)], "source_id string")
    found = H.read_history(spark, path, ids)
    assert Counter(r["source_id"] for r in found.collect()) == {"run-3": 8, "run-900": 8, "run-5000": 4, "none": 1}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN", plan) and re.search(r"PushedFilters: \[[^\]]*In\(source_id", plan)
    scanned = spark.read.parquet(path)
    buckets = [r[0] for r in ids.select(S.bucket_of("source_id", H.HISTORY_BUCKETS)).distinct().collect()]
    kept = scanned.where(F.col("bucket").isin(buckets)).select(F.input_file_name()).distinct().count()
    assert kept <= len(buckets) * 2 < scanned.select(F.input_file_name()).distinct().count() / 4


def test_a_repeated_run_replaces_only_its_events(spark, tmp_root):
    path = tmp_root + "/history"
    H.write_history(_events(spark, 400), path, "r1")
    H.write_history(_events(spark, 400), path, "r2")
    H.write_history(_events(spark, 40, "2026-02-02"), path, "r1")
    got = Counter((r["history_run"], str(r["event_time"])[:10]) for r in H.read_history(spark, path).collect())
    assert got == {("r2", "2026-01-01"): 400, ("r1", "2026-02-02"): 40}


@pytest.mark.parametrize("how, keys", [(O.order_records, O.RECORD_ORDER), (O.order_groups, O.GROUP_ORDER)])
def test_partition_borders_are_in_order(spark, how, keys):
    rng = random.Random(1)
    rows = [(rng.choice(["f1", "f1", "f2", "f3"]), i, rng.choice(["RETAIL", "ECOMMERCE"]), rng.choice(["t1", "t1", "t2", None]))
            for i in rng.sample(range(10_000), 3000)]
    df = spark.createDataFrame(rows, "source_id string, row_number long, sales_channel_code string, source_transaction_number string")
    ordered = how(df.repartition(7), 6).cache()
    borders = sorted(O.partition_borders(ordered, keys).collect(), key=lambda r: r["partition"])
    low = lambda x: tuple((v is not None, v) for v in x)
    assert len(borders) >= 4 and max(b["n"] for b in borders) < 1500  # a hot file or transaction is cut too
    assert all(low(a["last"]) < low(b["first"]) for a, b in zip(borders, borders[1:]))
    got = O.with_position(how(df, 6)).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 3001))
    at = [tuple((r[k] is not None, r[k]) for k in keys) for r in got]
    assert at == sorted(at)


def test_multiset_difference_is_except_all(spark):
    rng = random.Random(2)
    for change in range(4):
        rows = [(rng.randrange(20), rng.choice(["a", None, "b"]), rng.choice([None, 1.5])) for _ in range(300)]
        other = rows if not change else rows[change:] + [(3, "new", None)] * change
        schema = "k int, a string, b double"
        x, y = spark.createDataFrame(rows, schema), spark.createDataFrame(rng.sample(other, len(other)), schema)
        more, less = Counter(rows), Counter(other)
        expect = Counter({(*r, "first"): n for r, n in (more - less).items()} | {(*r, "second"): n for r, n in (less - more).items()})
        for by in (None, "k", "a"):
            assert Counter(map(tuple, C.multiset_difference(x, y, by).collect())) == expect
    # a null on either side of a value is no other row's null
    x, y = (spark.createDataFrame([r], "a string, b string") for r in ((None, "q"), ("q", None)))
    assert C.multiset_difference(x, y).count() == 2


def test_equal_runs_cost_one_aggregate_per_side(spark):
    df = spark.range(1000).withColumn("run_id", F.lit("r"))
    plan = replay_equivalence(df, df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Except" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("contract", BUILT_IN_CONTRACTS, ids=lambda c: c.contract_id)
def test_one_pass_verdicts_are_the_joined_ones(spark, contract):
    raw = raw_for(spark, SF, contract)
    one = one_pass_verdicts(raw, contract)
    joins = lambda df: len(re.findall(r"\w+Join ", df._jdf.queryExecution().sparkPlan().toString()))
    assert joins(one) == joins(raw)  # none of its own
    got = sorted(map(str, one.collect()))
    ing = ingest_rows(raw, contract, "r")
    joined = verdicts_for(ing)
    assert one.columns == joined.columns
    assert got == sorted(map(str, joined.collect()))
    ing.release()


def test_table_function_equals_the_parser(spark):
    rng = random.Random(6)
    documents = [(f"d{i}", "".join(rng.choice(['"', ",", "\n", "\r\n", "x", "é", 'q"']) for _ in range(rng.randrange(40))).encode())
                 for i in range(120)]
    documents += [("good", b'\xef\xbb\xbfa,b\n1,"x\ny"\n2,3'), ("bad", b"a,b\n1,2\n3\n"), ("utf", b"a\n\xff\n"), ("head", b"a,a\n")]
    blocks = []
    for path, data in documents:
        cuts = sorted({0, *(rng.randrange(len(data) + 1) for _ in range(3))})
        blocks += [(path, a, bytearray(data[a:b])) for a, b in zip(cuts, [*cuts[1:], len(data)])]
    rng.shuffle(blocks)
    spark.createDataFrame(blocks, "path string, block long, content binary").createOrReplaceTempView("csv_blocks")
    register_governed_csv(spark)
    got = spark.sql("SELECT * FROM governed_csv(TABLE(csv_blocks) PARTITION BY path ORDER BY block)").collect()
    sound = {r["path"] for r in got if r["kind"] == "file" and r["failure_category"] is None}
    got = [tuple(r) for r in got if r["kind"] == "file" or r["path"] in sound]
    plain = read_governed_csv(spark.createDataFrame(
        [(p, bytearray(d)) for p, d in documents], "source_id string, content binary")).collect()
    assert sorted(map(str, got)) == sorted(map(str, map(tuple, plain)))

"""Execution history as an append-only event log (S12, S13, J4, J5, A9,
W2-W4, K3-K6, O4, F16-F18).

The reference advances states in place with compare-and-set updates.  Over a
log, compare-and-set replay of the linear lifecycle
``(none) -> PENDING -> RUNNING -> terminal`` keeps exactly: the first PENDING
event, the first RUNNING event after it, and the first terminal event after
that; every other event is rejected.  That is three per-execution minimum
aggregates (hash/sort aggregates with partial combine), so one hot execution
never has to sit in a single window partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.domain import duration_micros, exit_status
from sluice.operators.skew import spread_join
from sluice.session import ensure_checkpoint_dir
from sluice.sources.sinks import bucket_of, path_exists, replace_partitions

TERMINAL_PIPELINE = ("SUCCEEDED", "BLOCKED", "FAILED")
# Legal lifecycle pairs (previous, next).
PIPELINE_TRANSITIONS = (("PENDING", "RUNNING"), ("RUNNING", "SUCCEEDED"),
                        ("RUNNING", "BLOCKED"), ("RUNNING", "FAILED"))
STAGE_TRANSITIONS = (("PENDING", "RUNNING"), ("PENDING", "SKIPPED"),
                     ("RUNNING", "SUCCEEDED"), ("RUNNING", "FAILED"))
LOG_SCHEMA = ("pipeline_execution_id string, event_id bigint, event_time timestamp, "
              "target_state string, failure_category string, failure_code string")


def _key(time_col: str = "event_time", id_col: str = "event_id") -> Column:
    return F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("i"))


def replay_pipeline_log(log: DataFrame, exec_col: str = "pipeline_execution_id") -> DataFrame:
    """Compare-and-set replay; one row per execution with state and
    timestamps (created/started/completed) and the accepted event keys."""
    k = _key()
    st = F.col("target_state")
    first_pending = log.where(st == "PENDING").groupBy(exec_col).agg(F.min(k).alias("k1"))
    with1 = spread_join(log, first_pending, exec_col, "inner", by=("event_id",))
    first_running = (with1.where((st == "RUNNING") & (k > F.col("k1")))
                     .groupBy(exec_col).agg(F.min(k).alias("k2")))
    with2 = spread_join(log, first_running, exec_col, "inner", by=("event_id",))
    first_terminal = (with2.where(st.isin(*TERMINAL_PIPELINE) & (k > F.col("k2")))
                      .groupBy(exec_col).agg(
                          F.min(F.struct(k.alias("k"), st.alias("s"),
                                         F.col("failure_category").alias("fc"),
                                         F.col("failure_code").alias("fcode"))).alias("_t")))
    out = (first_pending.join(first_running, exec_col, "left")
           .join(first_terminal, exec_col, "left"))
    state = (F.when(F.col("_t").isNotNull(), F.col("_t.s"))
             .when(F.col("k2").isNotNull(), F.lit("RUNNING")).otherwise(F.lit("PENDING")))
    return out.select(
        exec_col, state.alias("state"),
        F.col("k1.t").alias("created_at"), F.col("k2.t").alias("started_at"),
        F.col("_t.k.t").alias("completed_at"),
        F.when(F.col("_t.s") == "FAILED", F.col("_t.fc")).alias("failure_category"),
        F.when(F.col("_t.s") == "FAILED", F.col("_t.fcode")).alias("failure_code"),
        "k1", "k2", F.col("_t.k").alias("k3"))


def check_transitions(log: DataFrame, replayed: DataFrame,
                      exec_col: str = "pipeline_execution_id") -> DataFrame:
    """Every log event with the state it met and whether it was accepted;
    rejected events (illegal pair, or leaving a terminal state) carry
    ``prior_state -> target_state``."""
    k = _key()
    j = spread_join(log, replayed.select(exec_col, "k1", "k2", "k3", F.col("state").alias("_final")),
                    exec_col, "left", by=("event_id",))
    accepted = (k == F.col("k1")) | (k == F.col("k2")) | (k == F.col("k3"))
    prior = (
        F.when(F.col("k1").isNull() | (k <= F.col("k1")), F.lit(None).cast("string"))
        .when(F.col("k2").isNull() | (k <= F.col("k2")), F.lit("PENDING"))
        .when(F.col("k3").isNull() | (k <= F.col("k3")), F.lit("RUNNING"))
        .otherwise(F.col("_final"))
    )
    return j.select(exec_col, "event_id", "event_time", "target_state",
                    prior.alias("prior_state"),
                    F.coalesce(accepted, F.lit(False)).alias("accepted"),
                    _legal(PIPELINE_TRANSITIONS, prior, F.col("target_state")).alias("legal_pair"))


STAGE_SEQUENCE = {"INGESTION": 1, "TRANSFORMATION": 2, "DATA_QUALITY": 3}


def _legal(pairs, prior: Column, target: Column) -> Column:
    legal = prior.isNull() & (target == "PENDING")
    for a, b in pairs:
        legal = legal | ((prior == a) & (target == b))
    return F.coalesce(legal, F.lit(False))


def replay_stage_log(log: DataFrame, exec_col: str = "pipeline_execution_id",
                     stage_col: str = "stage") -> DataFrame:
    """W3 for stages: compare-and-set replay of a stage event log by STAGE_TRANSITIONS.

    Kept are the first PENDING event of a stage, the first RUNNING or SKIPPED event
    after it and, of a running stage, the first SUCCEEDED or FAILED event after that.
    One row per (execution, stage) that ever became PENDING."""
    keys = [exec_col, stage_col]
    k, st = _key(), F.col("target_state")
    first = log.where(st == "PENDING").groupBy(*keys).agg(F.min(k).alias("k1"))
    after = spread_join(log, first, keys, "inner", by=("event_id",))
    second = (after.where(st.isin("RUNNING", "SKIPPED") & (k > F.col("k1")))
              .groupBy(*keys).agg(F.min(F.struct(k.alias("k"), st.alias("s"))).alias("_b")))
    running = second.where(F.col("_b.s") == "RUNNING").select(*keys, F.col("_b.k").alias("k2"))
    after = spread_join(log, running, keys, "inner", by=("event_id",))
    third = (after.where(st.isin("SUCCEEDED", "FAILED") & (k > F.col("k2")))
             .groupBy(*keys).agg(F.min(F.struct(
                 k.alias("k"), st.alias("s"), F.col("failure_category").alias("fc"),
                 F.col("failure_code").alias("fcode"))).alias("_c")))
    rows = first.join(second, keys, "left").join(third, keys, "left")
    ran = F.col("_b.s") == "RUNNING"
    failed = F.col("_c.s") == "FAILED"
    sequence = F.element_at(F.create_map(*[F.lit(x) for kv in STAGE_SEQUENCE.items() for x in kv]), F.col(stage_col))
    return rows.select(
        *keys, sequence.cast("short").alias("stage_sequence"),
        F.coalesce(F.col("_c.s"), F.col("_b.s"), F.lit("PENDING")).alias("state"),
        F.when(ran, F.col("_b.k.t")).alias("started_at"),
        F.when(ran, F.col("_c.k.t")).otherwise(F.col("_b.k.t")).alias("completed_at"),
        F.when(failed, F.col("_c.fc")).alias("failure_category"),
        F.when(failed, F.col("_c.fcode")).alias("failure_code"),
        "k1", F.col("_b.k").alias("k2"), F.col("_b.s").alias("second_state"), F.col("_c.k").alias("k3"))


def check_stage_transitions(log: DataFrame, replayed: DataFrame, exec_col: str = "pipeline_execution_id",
                            stage_col: str = "stage") -> DataFrame:
    """W2 for stages: every event with the state it met, whether the pair is legal, and
    whether the event was accepted."""
    keys = [exec_col, stage_col]
    k = _key()
    j = spread_join(log, replayed.select(*keys, "k1", "k2", "k3", "second_state", F.col("state").alias("_final")),
                    keys, "left", by=("event_id",))
    prior = (F.when(F.col("k1").isNull() | (k <= F.col("k1")), F.lit(None).cast("string"))
             .when(F.col("k2").isNull() | (k <= F.col("k2")), F.lit("PENDING"))
             .when(F.col("k3").isNull() | (k <= F.col("k3")), F.col("second_state"))
             .otherwise(F.col("_final")))
    accepted = (k == F.col("k1")) | (k == F.col("k2")) | (k == F.col("k3"))
    return j.select(*keys, "event_id", "event_time", "target_state", prior.alias("prior_state"),
                    F.coalesce(accepted, F.lit(False)).alias("accepted"),
                    _legal(STAGE_TRANSITIONS, prior, F.col("target_state")).alias("legal_pair"))


def stage_order_check(log: DataFrame, replayed: DataFrame, exec_col: str = "pipeline_execution_id",
                      stage_col: str = "stage") -> DataFrame:
    """Per execution, whether a stage was announced twice (``duplicate_stage``) and
    whether stages were announced out of their governed order (``out_of_order``).

    An execution has one replayed row per governed stage, so its list has three
    elements at most."""
    twice = (log.where(F.col("target_state") == "PENDING").groupBy(exec_col, stage_col)
             .agg(F.count(F.lit(1)).alias("_n")).groupBy(exec_col).agg(F.max("_n").alias("_n")))
    order = replayed.groupBy(exec_col).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("k1", "stage_sequence"))), lambda x: x["stage_sequence"]).alias("_order"))
    return order.join(twice, exec_col).select(
        exec_col, (F.col("_n") > 1).alias("duplicate_stage"),
        (F.col("_order") != F.array_sort("_order")).alias("out_of_order"))


def last_event_rows(log: DataFrame, keys, running: str = "RUNNING", terminal=("SUCCEEDED", "FAILED", "SKIPPED")) -> DataFrame:
    """A table kept by plain updates, without compare-and-set: the last event names the
    state, the first ones of a kind give the times. Its rows may break the shapes
    of K4, which is what that check is for."""
    st = F.col("target_state")
    return log.groupBy(*keys).agg(
        F.max_by(st, _key()).alias("state"), F.min("event_time").alias("created_at"),
        F.min(F.when(st == running, F.col("event_time"))).alias("started_at"),
        F.min(F.when(st.isin(*terminal), F.col("event_time"))).alias("completed_at"),
        F.max("failure_category").alias("failure_category"), F.max("failure_code").alias("failure_code"))


#: Buckets of a day's events, and ids that are looked up by value; more are joined.
HISTORY_BUCKETS = 32
LOOKUP_IDS = 1000


def write_history(events: DataFrame, path: str, run_id: str, id_col: str = "source_id") -> None:
    """Append the events of one run, by (day of the event, bucket of the execution).

    Rows are sorted by id and every file has a Bloom filter of its ids, so a lookup reads few row
    groups. A run that is repeated replaces its own events and no others: only then are
    the days it had written to rewritten; a new run just adds files."""
    spark = events.sparkSession
    ensure_checkpoint_dir(spark)
    # events without a time share a day of their own
    day = F.coalesce(F.to_date("event_time"), F.lit("1970-01-01").cast("date")) if "event_time" in events.columns else (
        F.lit("1970-01-01").cast("date"))
    new = events.withColumns({
        "history_run": F.lit(run_id), "event_day": day, "bucket": bucket_of(id_col, HISTORY_BUCKETS)})
    keys, options = ["event_day", "bucket"], {f"parquet.bloom.filter.enabled#{id_col}": "true"}
    days = None
    if path_exists(spark, path):
        stored = spark.read.parquet(path)
        days = stored.where(F.col("history_run") == run_id).select(*keys).distinct().checkpoint()
    again = days is not None and not days.isEmpty()
    if again:  # the days of one run x buckets
        kept = stored.where(F.col("history_run") != run_id).join(
            F.broadcast(days.unionByName(new.select(*keys).distinct()).distinct()), keys, "left_semi")
        new = new.unionByName(kept.select(*new.columns)).checkpoint()
    new = new.hint("rebalance", *keys).sortWithinPartitions(*keys, id_col)
    if again:
        replace_partitions(new, path, keys, days, options)
    else:
        new.write.mode("append").partitionBy(*keys).options(**options).parquet(path)


def read_history(spark, path: str, ids: DataFrame | None = None, id_col: str = "source_id") -> DataFrame:
    """The stored events, of the named executions if ``ids`` is given; an id
    without any event is returned once with ``found`` false.

    Up to LOOKUP_IDS ids become values of the filter, which prunes buckets, row groups by
    their least and greatest id, and for a few ids row groups by Bloom filter."""
    events = spark.read.parquet(path).withColumn("found", F.lit(True))
    if ids is None:
        return events.drop("event_day", "bucket")
    ids = ids.select(id_col).distinct()
    few = ids.withColumn("bucket", bucket_of(id_col, HISTORY_BUCKETS)).limit(LOOKUP_IDS + 1).collect()
    if len(few) <= LOOKUP_IDS:
        wanted = [r[id_col] for r in few if r[id_col] is not None]
        events = events.where(F.col("bucket").isin(sorted({r["bucket"] for r in few})) & F.col(id_col).isin(wanted))
    return ids.join(events.drop("event_day", "bucket"), id_col, "left").withColumn(
        "found", F.coalesce("found", F.lit(False)))


def nest_stages(stages: DataFrame, exec_col: str = "pipeline_execution_id") -> DataFrame:
    """A9 + O4: the stages of an execution as one array in sequence order.
    An execution has exactly three stages, so the array is bounded."""
    return stages.groupBy(exec_col).agg(F.array_sort(F.collect_list(F.struct(
        F.col("stage_sequence").alias("stage_sequence"), "stage", "state", "started_at",
        "completed_at", "failure_category", "failure_code"))).alias("stages"))


def join_history(executions: DataFrame, stages: DataFrame,
                 exec_col: str = "pipeline_execution_id") -> DataFrame:
    """J4 + S13: each execution with its nested stages."""
    return executions.join(nest_stages(stages, exec_col), exec_col, "left")


def predecessor_link(executions: DataFrame, exec_col: str = "pipeline_execution_id",
                     pred_col: str = "predecessor_execution_id") -> DataFrame:
    """Optional self reference; flags self links and missing predecessors."""
    parents = executions.select(F.col(exec_col).alias("_pid"), F.col("state").alias("predecessor_state"))
    j = executions.join(parents, F.col(pred_col) == F.col("_pid"), "left")
    return j.select(
        exec_col, pred_col, "predecessor_state",
        (F.col(pred_col).isNotNull() & (F.col(pred_col) == F.col(exec_col))).alias("self_reference"),
        (F.col(pred_col).isNotNull() & F.col("_pid").isNull()).alias("missing_predecessor"))


def runtime_metrics(executions: DataFrame, stages: DataFrame,
                    exec_col: str = "pipeline_execution_id") -> DataFrame:
    """K5 + F16: durations (microseconds) per execution and per stage."""
    per_stage = stages.groupBy(exec_col).pivot("stage", ["INGESTION", "TRANSFORMATION", "DATA_QUALITY"]).agg(
        F.first(duration_micros("started_at", "completed_at")))
    return executions.select(
        exec_col, "state", duration_micros("started_at", "completed_at").alias("duration_us")
    ).join(per_stage.select(exec_col,
                            F.col("INGESTION").alias("ingestion_us"),
                            F.col("TRANSFORMATION").alias("transformation_us"),
                            F.col("DATA_QUALITY").alias("data_quality_us")), exec_col, "left")


def operator_report(executions: DataFrame, exec_col: str = "pipeline_execution_id") -> DataFrame:
    """K6 + F18: bounded fields only (ids, states, times, failure) and the
    process exit status."""
    return executions.select(exec_col, "state", "created_at", "started_at", "completed_at",
                             "failure_category", "failure_code",
                             exit_status("state").alias("exit_status"))


def history_events(verdicts: DataFrame, run_started: str) -> DataFrame:
    """K3: the event log a verdict implies: PENDING / RUNNING / terminal for
    the execution and each stage, one second apart from ``run_started``."""
    base = F.unix_micros(F.lit(run_started).cast("timestamp"))
    execs = []
    execs.append(F.struct(F.lit(None).cast("string").alias("stage"), F.lit(0).alias("seq"),
                          F.lit("PENDING").alias("target_state"), F.lit(0).alias("offset_s")))
    execs.append(F.struct(F.lit(None).cast("string").alias("stage"), F.lit(1).alias("seq"),
                          F.lit("RUNNING").alias("target_state"), F.lit(1).alias("offset_s")))
    for i, (name, seq) in enumerate((("INGESTION", 1), ("TRANSFORMATION", 2), ("DATA_QUALITY", 3))):
        st = F.col("stages")[i]["state"]
        execs.append(F.struct(F.lit(name).alias("stage"), F.lit(10 * seq).alias("seq"),
                              F.when(st != "SKIPPED", F.lit("RUNNING")).alias("target_state"),
                              F.lit(2 * seq).alias("offset_s")))
        execs.append(F.struct(F.lit(name).alias("stage"), F.lit(10 * seq + 1).alias("seq"),
                              st.alias("target_state"), F.lit(2 * seq + 1).alias("offset_s")))
    execs.append(F.struct(F.lit(None).cast("string").alias("stage"), F.lit(99).alias("seq"),
                          F.col("state").alias("target_state"), F.lit(8).alias("offset_s")))
    ev = verdicts.select("source_id", "source_identifier", F.inline(F.array(*execs)))
    return ev.where(F.col("target_state").isNotNull()).select(
        "source_id", "source_identifier", "stage", "seq", "target_state",
        F.timestamp_micros(base + F.col("offset_s") * 1_000_000).alias("event_time"))

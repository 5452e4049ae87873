"""Structured Streaming versions of the pipeline.

The reference polls a folder every 15 minutes and signals over pub/sub. Here
a file source with a checkpoint picks up each new file exactly once, a
``foreachBatch`` sink runs the batch cleaning job on the micro-batch and
writes its partitions idempotently, and status/events are plain tables.
Checkpoints live under ``spark.checkpoint.dir`` (shared storage), so a lost
executor or a restarted driver resumes where the last commit left off.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, staging
from ..sources import commits as C
from ..sources.storage import write_table

# Event names; the cleaner accepts both ingest names (the
# reference waited for one and sent the other).
INGEST_EVENTS = ("data_ingested", "comprehensive_data_ingested")
PROCESSED_EVENT = "data_processed"

# Fields of the services' messages; pass another schema for messages with more.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("symbols", T.ArrayType(T.StringType())),
    T.StructField("files_created", T.LongType()),
    T.StructField("files_processed", T.LongType()),
    T.StructField("data_summary", T.MapType(T.StringType(), T.LongType())),
    T.StructField("summary", T.StructType([
        T.StructField("run_id", T.StringType()), T.StructField("total_files_processed", T.LongType()),
        T.StructField("average_quality_score", T.DoubleType())])),
])


def stream_ingest(spark: SparkSession, src: str, root: str, checkpoint: str, fmt: str = "parquet",
                  trigger: dict | None = None):
    """The ingest loop as a stream: landed payload files in ``src`` (landing
    schema) become the 12 tables under ``root`` (partitioned by batch), each file
    exactly once.

    A micro-batch is first added to ``root/landing``, partitioned by (batch_id,
    load), where a load is one epoch of this query: a replayed epoch replaces its
    own partitions only. The batches that it touched are then rebuilt from all
    their loads, so a batch whose files arrive in several micro-batches keeps
    every row, and untouched batches are neither read nor written. ``root`` is a folder of the
    stream's own, with plain tables; that of ``run_ingest`` has a commit log."""
    from ..sources.feeds import LANDING_SCHEMA, normalize_all
    stream = spark.readStream.schema(LANDING_SCHEMA).format(fmt).load(src)

    def run(df: DataFrame, epoch: int) -> None:
        session, load = df.sparkSession, epoch_run(df, epoch)
        with staging(session):
            write_table(df.withColumn("load", F.lit(load)), f"{root}/landing", ["batch_id", "load"])
            landing = session.read.parquet(f"{root}/landing")
            touched = landing.where(F.col("load") == load).select("batch_id").distinct()
            whole = landing.join(touched, "batch_id", "left_semi").select(*LANDING_SCHEMA.fieldNames())
            for name, table in normalize_all(whole).items():
                write_table(table, f"{root}/{name}")

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())


def stream_clean(spark: SparkSession, src: str, dst: str, checkpoint: str,
                 schema: T.StructType, clean: Callable[[DataFrame], DataFrame],
                 fmt: str = "parquet", trigger: dict | None = None, batch: str = "batch_id",
                 landing: str | None = None):
    """Every new file of ``src`` is picked up once; the batches it
    belongs to are cleaned and written to ``dst``.

    Each micro-batch first adds its rows to ``landing`` (beside the checkpoint by default), by
    (batch, load) with a load per epoch, and then cleans the complete rows of the batches it
    touched from there: when one batch's files arrive in two micro-batches the second
    overwrite still holds the whole batch, and neither the source nor other batches are
    read again. ``trigger`` defaults to
    ``availableNow`` (process what is there, stop); pass
    ``{"processingTime": "15 minutes"}`` for the reference's cadence. A
    failed micro-batch is retried from the checkpoint; the partitioned
    dynamic overwrite makes the retry idempotent. Intermediate tables go when a micro-batch ends.
    """
    stream = spark.readStream.schema(schema).format(fmt).load(src)
    landing = landing or f"{checkpoint.rstrip('/')}-landing"

    def run(df: DataFrame, epoch: int) -> None:
        session, load = df.sparkSession, epoch_run(df, epoch)
        with staging(session):
            write_table(df.withColumn("load", F.lit(load)), landing, [batch, "load"])
            if not C.exists(session, landing):
                return
            rows = session.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())])).parquet(landing)
            touched = rows.where(F.col("load") == load).select(batch).distinct()
            write_table(clean(rows.join(touched, batch, "left_semi").select(*schema.fieldNames())), dst, batch)

    q = (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
               .trigger(**(trigger or {"availableNow": True})).start())
    return q


def epoch_run(df: DataFrame, epoch: int) -> str:
    """Run id of a micro-batch: the same when the epoch is replayed."""
    return f"s{df.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{epoch}"


# ISO-8601 with microseconds, as Python's ``isoformat()`` writes it.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def to_message(df: DataFrame) -> DataFrame:
    """Rows -> one JSON message per row (timestamps keep microseconds)."""
    return df.select(F.to_json(F.struct(*df.columns), {"timestampFormat": TS_FORMAT}).alias("message"))


def parse_events(messages: DataFrame, col: str = "message", schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """JSON messages -> typed events; malformed messages get null ``event``."""
    return messages.select(F.from_json(F.col(col), schema, {"timestampFormat": TS_FORMAT})
                           .alias("e")).select("e.*")


def event_filter(messages: DataFrame, types: Sequence[str] = INGEST_EVENTS,
                 col: str = "message", schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """Events of the given types; malformed messages go to
    ``event_quarantine``. Works on a static or a streaming frame."""
    return parse_events(messages, col, schema).where(F.col("event").isin(list(types)))


def event_quarantine(messages: DataFrame, col: str = "message") -> DataFrame:
    """Messages that are no events, with a reason: empty, malformed JSON, or
    JSON without an ``event``. Static or streaming; other columns are kept."""
    m = F.col(col)
    reason = (F.when(m.isNull() | (F.trim(m) == ""), F.lit("empty_message"))
               .when(F.try_parse_json(m).isNull(), F.lit("malformed_json"))
               .when(F.get_json_object(m, "$.event").isNull(), F.lit("no_event")))
    return messages.withColumn("reason", reason).where(F.col("reason").isNotNull())


def event_stream(spark: SparkSession, src: str, types: Sequence[str] = INGEST_EVENTS) -> DataFrame:
    """T02 as a stream: JSON-lines messages landing in ``src`` (one message
    per line), filtered to ``types``; bad lines are ``event_quarantine``'s."""
    msgs = spark.readStream.text(src).withColumnRenamed("value", "message")
    return event_filter(msgs, types)


def clean_on_events(spark: SparkSession, events: str, raw_dir: str, root: str, checkpoint: str,
                    types: Sequence[str] = INGEST_EVENTS, trigger: dict | None = None):
    """The cleaning run as a consumer of events. Messages that land in ``events`` (text, one JSON
    message a line) start ``run_cleaning`` over ``raw_dir`` whenever a micro-batch holds one of ``types``:
    one run however many there are. The run's id is the epoch's, and its commit takes the
    events along (table ``handled_events``), so a replayed epoch cleans nothing again; bad
    messages are kept in ``bad_events`` with a reason."""
    from ..plans.jobs import run_cleaning
    stream = spark.readStream.text(events).withColumnRenamed("value", "message")

    def run(df: DataFrame, epoch: int) -> None:
        session, run_id = df.sparkSession, epoch_run(df, epoch)
        if C.is_committed(session, root, run_id):
            return
        df.persist()
        try:
            wanted = event_filter(df, types).select("event", "timestamp")
            also = {"handled_events": wanted.withColumn("run_id", F.lit(run_id)), "bad_events": event_quarantine(df)}
            if not wanted.isEmpty():
                run_cleaning(session, raw_dir, root, run_id, also)
            elif not also["bad_events"].isEmpty():
                C.stage_rows(also["bad_events"], root, "bad_events", run_id, [])
                C.commit(session, root, run_id, "events", {"bad_events": []})
        finally:
            df.unpersist()

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())


def status_latest(log: DataFrame, keys: Sequence[str] = ("service", "field")) -> DataFrame:
    """Last write wins per (service, field) by (ts, seq); a field that a
    later update does not mention keeps its older value. A grouped
    ``max_by`` - partial aggregation, no window. On a stream use
    ``outputMode('update')``."""
    order = F.struct("ts", "seq")
    return log.groupBy(*keys).agg(F.max_by("value", order).alias("value"), F.max("ts").alias("ts"))


STATUS_SCHEMA = "service string, field string, value string, ts timestamp, seq long"


def stream_status(log: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, table: str = "status_current"):
    """T03 as a stream: a streaming status log (service, field, value, ts, seq) kept as the current
    value of every field in ``table`` of the store ``root``. The state store holds one
    (value, ts, seq) per field (``max_by`` in update mode); a micro-batch hands over the fields
    that changed, and the partitions of their services are written anew with them and committed
    under the epoch's id, so a replayed epoch changes nothing and a reader sees whole services."""
    order = F.struct("ts", "seq")
    latest = log.groupBy("service", "field").agg(F.max_by(F.struct("value", "ts", "seq"), order).alias("w"))

    def run(df: DataFrame, epoch: int) -> None:
        session, run_id = df.sparkSession, epoch_run(df, epoch)
        if C.is_committed(session, root, run_id):
            df.write.format("noop").mode("overwrite").save()  # the state store takes part in every epoch
            return
        with staging(session):
            changed = materialize(df.select("service", "field", "w.*"), "status-changed")
            before = C.read(session, root, table)
            if before is not None:
                changed = changed.unionByName(before.join(changed.select("service").distinct(), "service", "left_semi"))
            now = changed.groupBy("service", "field").agg(F.max_by(F.struct("value", "ts", "seq"), order).alias("w"))
            C.stage_rows(now.select("service", "field", "w.*"), root, table, run_id, ["service"])
            C.commit(session, root, run_id, "stream_status", {table: ["service"]})

    return (latest.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())


def emit_events(summary: DataFrame, event: str = PROCESSED_EVENT) -> DataFrame:
    """The result event of a cleaning run as a row (append it to the
    event table, e.g. from ``foreachBatch``); ``message`` is its JSON text. The
    event carries the run's totals; its files are found by ``run_id``."""
    e = summary.select(F.lit(event).alias("event"), F.col("timestamp"),
                       F.col("total_files_processed").alias("files_processed"),
                       F.col("average_quality_score"), F.struct(*summary.columns).alias("summary"))
    return e.withColumn("message", F.to_json(F.struct("event", "timestamp", "files_processed", "summary")))


def service_state(spark: SparkSession, service: str, status: str, message: str) -> DataFrame:
    """A service's own status update as long rows (service, field, value, ts, seq): the
    states ``fetching`` / ``processing`` at the start of a run, ``idle`` when
    nothing is pending, ``error`` when it failed. Message texts are the caller's."""
    now = F.current_timestamp()
    fields = F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in (
        ("status", F.lit(status)), ("message", F.lit(message)), ("timestamp", F.date_format(now, TS_TEXT)))])
    return spark.range(1).select(F.lit(service).alias("service"), F.inline(fields), now.alias("ts"),
                                 F.lit(0).cast("bigint").alias("seq"))


def clean_status(summary: DataFrame, files: DataFrame | None = None, service: str = "data_clean") -> DataFrame:
    """The status update of a cleaning run with a summary as long rows
    ``(service, field, value, ts, seq)``: ``completed`` when files were
    processed, ``idle`` when there was nothing to do. ``files`` (input_file) adds the
    sorted JSON list ``processed_files``: file names of this run, no more. Runs
    without a summary report by ``service_state``."""
    n = F.col("total_files_processed")
    # Field names and texts of the status.
    fields = [
        F.struct(F.lit("status").alias("field"),
                 F.when(n > 0, F.lit("completed")).otherwise(F.lit("idle")).alias("value")),
        F.struct(F.lit("files_processed").alias("field"), n.cast("string").alias("value")),
        F.struct(F.lit("average_quality_score").alias("field"), F.col("average_quality_score").cast("string").alias("value")),
        F.struct(F.lit("message").alias("field"),
                 F.format_string("Successfully processed %d files", n).alias("value")),
        F.struct(F.lit("timestamp").alias("field"), F.date_format("timestamp", TS_TEXT).alias("value"))]
    s = summary
    if files is not None:
        names = files.agg(F.to_json(F.array_sort(F.collect_list("input_file"))).alias("_mf_files"))
        s = s.withColumn("_mf_one", F.lit(1)).join(names.withColumn("_mf_one", F.lit(1)), "_mf_one")
        fields.append(F.struct(F.lit("processed_files").alias("field"), F.col("_mf_files").alias("value")))
    return s.select(F.lit(service).alias("service"), F.inline(F.array(*fields)), F.col("timestamp").alias("ts"),
                    F.lit(0).cast("bigint").alias("seq"))


def ingest_status(summary: DataFrame, service: str = "data_ingest", batch: str = "batch_id") -> DataFrame:
    """T03 source rows of the ingest service per batch from
    ``feeds.ingest_summary(..., quotes=...)``: status, message, the fetched
    symbols and data types as JSON lists, and the number of files created."""
    from ..sources.feeds import SUMMARY_KEYS
    syms = F.coalesce(F.col("symbols"), F.array().cast("array<string>"))
    kinds = F.array(*[F.lit(k) for k in SUMMARY_KEYS.values()])
    # Field names and texts of the status.
    fields = F.array(
        F.struct(F.lit("status").alias("field"), F.lit("completed").alias("value")),
        F.struct(F.lit("message").alias("field"),
                 F.format_string("Successfully fetched comprehensive data for %d symbols", F.size(syms)).alias("value")),
        F.struct(F.lit("symbols_fetched").alias("field"), F.to_json(syms).alias("value")),
        F.struct(F.lit("files_created").alias("field"), F.col("files_created").cast("string").alias("value")),
        F.struct(F.lit("data_types").alias("field"), F.to_json(kinds).alias("value")))
    return summary.select(F.lit(service).alias("service"), F.col(batch), F.inline(fields))


def stream_dedup(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop duplicates of ``keys`` arriving within ``delay`` of each other. State is
    bounded by the watermark: a copy that comes later than ``delay`` after the
    first is kept. ``stream_dedup_exact`` keeps none."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_dedup_exact(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """T05 without a time limit: drops every later copy of ``keys``, at the price of
    state that holds each key once."""
    return df.dropDuplicates(list(keys))


def stream_dedup_store(df: DataFrame, keys: Sequence[str], ts: str, dst: str, seen: str, checkpoint: str,
                       delay: str = "1 hour", buckets: int = 64, trigger: dict | None = None):
    """T05, exact with bounded state: the first row of every ``keys`` goes to ``dst`` and no later copy
    ever does. Copies within ``delay`` are dropped by the state store, whose keys leave
    it with the watermark; older ones by an anti-join with the keys stored in ``seen``, which lie by
    (hash bucket, epoch). Rows and keys of an epoch are replaced when it is replayed, and it does not
    count its own keys as seen."""
    recent = stream_dedup(df, keys, ts, delay)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("kb", T.IntegerType()),
                           T.StructField("epoch", T.LongType())])

    def run(rows: DataFrame, epoch: int) -> None:
        session = rows.sparkSession
        rows = rows.dropDuplicates(list(keys)).withColumn("kb", bucket)
        if C.exists(session, seen):
            old = session.read.schema(schema).parquet(seen).where(F.col("epoch") < epoch)
            on = [rows[k].eqNullSafe(old[k]) for k in keys] + [rows["kb"] == old["kb"]]
            rows = rows.join(old, on, "left_anti")
        # keys first: a run that dies between the two writes is replayed and writes both again
        with staging(session):
            rows = materialize(rows.withColumn("epoch", F.lit(epoch).cast("long")), "stream-first")
            write_table(rows.select(*keys, "kb", "epoch"), seen, ["kb", "epoch"])
            write_table(rows.drop("kb"), dst, "epoch")

    return (recent.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())

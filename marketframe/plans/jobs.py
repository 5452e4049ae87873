"""End-to-end batch jobs: the reference's ingest run and cleaning run as
Spark jobs over shared storage (everything below ``root`` is a table folder).

``run_ingest``   landing payloads -> 12 batch-partitioned tables, ingest
                 summary, status rows and the ingest event.
``run_cleaning`` raw CSV batch files -> pending batches only -> processed
                 quotes / bars tables, per-batch report, run summary (JSON),
                 status rows and the result event.

A run is one transaction (``sources.commits``): it stages its rows of every table in folders
of its own and ends with one commit, so a run that dies has added nothing, neither
a batch nor an event, and may simply be repeated. ``commits.read(spark, root, table)``
gives the committed rows; a batch that runs again is replaced. The cleaning run skips
batches that a committed run has handled (anti-join of the file listing on ``(kind, batch_id)``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import report as R
from ..session import materialize, staging
from ..sources import commits as C
from ..sources import feeds as FD
from ..sources import storage as S
from ..streaming import streams as ST

# Raw CSV layouts of the two kinds of batch files (the reference's columns).
QUOTE_CSV = T.StructType([T.StructField(n, t) for n, t in [
    ("symbol", T.StringType()), ("current_price", T.DoubleType()), ("high_price", T.DoubleType()),
    ("low_price", T.DoubleType()), ("open_price", T.DoubleType()), ("previous_close", T.DoubleType()),
    ("change", T.DoubleType()), ("change_percent", T.DoubleType()), ("timestamp", T.StringType())]])
BAR_CSV = T.StructType([T.StructField(n, t) for n, t in [
    ("symbol", T.StringType()), ("date", T.StringType()), ("open", T.DoubleType()), ("high", T.DoubleType()),
    ("low", T.DoubleType()), ("close", T.DoubleType()), ("volume", T.DoubleType())]])


def _state(spark: SparkSession, root: str, service: str, status: str, message: str) -> None:
    """A status update that is visible at once, whatever becomes of the run."""
    run = C.new_run()
    C.stage_rows(ST.service_state(spark, service, status, message), root, "status_log", run, [])
    C.commit(spark, root, run, f"{service}-state", {"status_log": []})


def run_ingest(spark: SparkSession, landing: DataFrame, root: str, run_id: str | None = None) -> DataFrame:
    """Normalize every feed of the landing frame into ``root/<table>``
    (partitioned by batch), then write the ingest summary, status and event of the
    batches in it, and commit it all. The rows are first written to the run's own part of
    ``landing``, by (batch_id, feed): each of the 12 normalizers reads its partitions of
    this run only. A landing frame holds a batch's feed whole; a later run replaces
    it. States: ``fetching`` at the start, ``error`` if the run fails. A ``run_id`` that has been
    committed is not run again. Returns the per-batch summary of this run."""
    run = run_id or C.new_run()
    if run_id is not None and C.is_committed(spark, root, run):
        return C.staged_rows(spark, root, "ingest_summary", run)
    _state(spark, root, "data_ingest", "fetching", "Starting data ingestion")
    try:
        with staging(spark):
            return _ingest(spark, landing, root, run)
    except Exception as e:
        _state(spark, root, "data_ingest", "error", f"Error during ingestion: {type(e).__name__}")
        raise


def _ingest(spark: SparkSession, landing: DataFrame, root: str, run: str) -> DataFrame:
    C.stage_rows(landing, root, "landing", run, ["batch_id", "feed"])
    mine = C.staged_rows(spark, root, "landing", run)
    tables = FD.normalize_all(mine if mine is not None else landing.limit(0))
    for name, df in tables.items():
        C.stage_rows(df, root, name, run)                      # empty feed -> no partition
    # the batches of one run, as literals: they prune the partitions of all that is read here
    ids = [] if mine is None else [r["batch_id"] for r in mine.select("batch_id").distinct().collect()]
    stored = {name: C.read(spark, root, name, run) for name in tables}
    stored = {name: df.where(F.col("batch_id").isin(ids)) for name, df in stored.items() if df is not None}
    C.stage_rows(FD.ingest_summary(stored, quotes=stored.get("quotes")), root, "ingest_summary", run)
    summary = C.staged_rows(spark, root, "ingest_summary", run)
    if summary is not None:
        status = ST.ingest_status(summary).select(
            "service", "field", "value", F.current_timestamp().alias("ts"), F.lit(0).cast("bigint").alias("seq"))
        C.stage_rows(status, root, "status_log", run, [])
        event = summary.select(F.lit("comprehensive_data_ingested").alias("event"),
                               F.current_timestamp().alias("timestamp"), "symbols", "files_created", "data_summary")
        C.stage_rows(event.select(F.to_json(F.struct("*")).alias("message")), root, "events", run, [])
    C.commit(spark, root, run, "ingest", {"landing": ["batch_id", "feed"], **{name: ["batch_id"] for name in tables},
                                          "ingest_summary": ["batch_id"], "status_log": [], "events": []})
    return summary


# kind -> (file name pattern, CSV layout, cleaner, table); the layouts' text dates are parsed below
KINDS = {
    "quotes": ("stock_quotes_*.csv", QUOTE_CSV, R.clean_quotes, "processed_quotes"),
    "historical": ("stock_historical_*.csv", BAR_CSV, R.clean_bars, "processed_bars"),
}


def pending_files(spark: SparkSession, raw_dir: str, root: str) -> DataFrame:
    """(kind, batch_id, path) of raw files whose batch no run has handled yet: the
    listing's names, parsed and anti-joined before any content is read."""
    files = S.list_files(spark, raw_dir, "stock_*.csv").select(
        "path", S.parse_batch(F.col("file_name")).alias("b")).select("b.kind", "b.batch_id", "path")
    files = files.where(F.col("batch_id").isNotNull())
    done = C.read(spark, root, "handled_batches")
    if done is not None:
        files = files.join(done.select("kind", "batch_id").distinct(), ["kind", "batch_id"], "left_anti")
    return files


#: Partition columns of the tables that a cleaning run writes.
CLEAN_TABLES = {"processed_quotes": ["batch_id"], "processed_bars": ["batch_id"], "quarantine": ["kind", "batch_id"],
                "cleaning_reports": ["file_type", "batch_id"], "run_files": [], "run_summaries": [], "status_log": [],
                "events": [], "handled_batches": []}


def run_cleaning(spark: SparkSession, raw_dir: str, root: str, run_id: str | None = None,
                 also: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """Clean the pending raw batches under ``raw_dir`` (files named
    ``stock_quotes_<id>.csv`` / ``stock_historical_<id>.csv``) into ``root``.

    Only pending files are read. Malformed rows go to ``quarantine`` by (kind,
    batch_id), replaced if a batch runs again; a batch with nothing but such rows
    counts as handled too. States: ``processing``, then ``completed``, ``idle``
    (nothing pending) or ``error``. A ``run_id`` that has been committed is not run
    again. The rows of ``also`` are added to the tables it names, in the run's commit. Returns the run's totals (one row), or ``None`` when no batch gave rows."""
    run = run_id or C.new_run()
    if run_id is not None and C.is_committed(spark, root, run):
        return C.staged_rows(spark, root, "run_summaries", run, "json")
    _state(spark, root, "data_clean", "processing", "Starting data cleaning")
    try:
        with staging(spark):
            return _clean(spark, raw_dir, root, run, also or {})
    except Exception as e:
        _state(spark, root, "data_clean", "error", f"Error during cleaning: {type(e).__name__}")
        raise


def _clean(spark: SparkSession, raw_dir: str, root: str, run: str, also: dict[str, DataFrame]) -> DataFrame | None:
    for name, rows in also.items():
        C.stage_rows(rows, root, name, run, [])
    more = {name: [] for name in also}
    pending = materialize(pending_files(spark, raw_dir, root), "pending-files")
    if pending.isEmpty():
        C.commit(spark, root, run, "clean", more)
        _state(spark, root, "data_clean", "idle", "No new files to process")
        return None
    reports, bad = [], []
    for kind, (_, layout, clean, table) in KINDS.items():
        paths = [r["path"] for r in pending.where(F.col("kind") == kind).select("path").collect()]  # one per file
        if not paths:
            continue
        raw, wrong = S.read_raw_batches(spark, paths, layout)
        bad.append(wrong)
        raw = raw.drop("kind")
        if kind == "quotes":
            raw = raw.withColumn("timestamp", F.try_to_timestamp("timestamp"))
        else:
            raw = raw.withColumn("date", F.to_date(F.try_to_timestamp("date", F.lit("yyyy-MM-dd"))))
        C.stage_rows(clean(raw), root, table, run, cluster=["symbol", "timestamp" if kind == "quotes" else "date"])
        processed = C.staged_rows(spark, root, table, run)
        if processed is not None:
            reports.append(R.cleaning_report(raw, processed, kind))
    C.stage_rows(S.union_batches(*bad), root, "quarantine", run, ["kind", "batch_id"])
    C.stage_rows(pending.select("kind", "batch_id", F.lit(run).alias("run_id")), root, "handled_batches", run, [])
    rep = materialize(S.union_batches(*reports), "run-report") if reports else None
    done = rep is not None and not rep.isEmpty()
    if done:
        C.stage_rows(rep, root, "cleaning_reports", run, ["file_type", "batch_id"])
        entries = R.file_entries(rep, run)
        C.stage_rows(entries, root, "run_files", run, [])
        summary = materialize(R.run_summary(rep, run), "run-summary")
        C.stage_rows(summary, root, "run_summaries", run, [], "json")
        C.stage_rows(ST.clean_status(summary, entries), root, "status_log", run, [])
        C.stage_rows(ST.emit_events(summary).select("message"), root, "events", run, [])
    C.commit(spark, root, run, "clean", CLEAN_TABLES | more, {"run_summaries": "json"})
    if not done:
        _state(spark, root, "data_clean", "error", "No file could be processed")
        return None
    return C.staged_rows(spark, root, "run_summaries", run, "json")

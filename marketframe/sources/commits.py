"""Commit log of a store: what a run writes becomes visible at once, or never.

A store is a folder ``root`` with a folder per table. A run writes its rows of a table
under ``root/<table>/mf_run=<run>/<partitions>``, where nobody looks yet, and ends with one
commit: a single file added to ``root/commits`` that names every (table, partition) of the run.
A file appears by one rename, so a run that dies anywhere before it has changed nothing,
and one that is repeated with the same id replaces its own folders and commits once.

Readers take, for every partition, the run that committed it last: a later run replaces
a batch without touching the files that a reader may still hold. Tables without partition
columns (events, status) are kept by run, so a run adds its rows once, however often it is tried.

``expire`` commits the removal of old partitions; ``vacuum`` deletes the files that no
reader can reach any more: of partitions replaced or removed, and of runs that never
committed, both after a time of grace for readers in flight; and folds the log's small files.

The log has a row per partition of a run; the newest one per partition is a grouped maximum, and its
semi-join on the run and partition columns prunes what is scanned.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import clustered, skipping_options

RUN = "mf_run"
LOG = "commits"
LOG_SCHEMA = ("run_id string, job string, seq long, committed_at timestamp, table string, by array<string>, "
              "part array<string>, removed boolean")


def new_run() -> str:
    """A fresh run id; ids start with a letter, so no folder name looks like a number."""
    return f"r{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.format(fmt).load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


@contextmanager
def _text_partitions(spark: SparkSession):
    """Partition values are read as the text they were written as."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_path(root: str, table: str, run_id: str) -> str:
    return f"{root}/{table}/{RUN}={run_id}"


def stage_rows(df: DataFrame, root: str, table: str, run_id: str, by: Sequence[str] = ("batch_id",),
               fmt: str = "parquet", cluster: Sequence[str] = ()) -> None:
    """Writes a run's rows of a table where readers do not look before ``commit``. A repeated
    call replaces them. With ``cluster`` (a series and its order) they are laid out for data
    skipping, see ``storage.clustered``."""
    if cluster:
        df = clustered(df, by, cluster)
    w = df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "static")
    w = w.options(**skipping_options(cluster[0])) if cluster else w
    (w.partitionBy(*by) if by else w).save(run_path(root, table, run_id))


def staged_rows(spark: SparkSession, root: str, table: str, run_id: str, fmt: str = "parquet") -> DataFrame | None:
    """A run's own rows of a table, committed or not; None if it wrote none."""
    path = run_path(root, table, run_id)
    if not exists(spark, path, fmt):
        return None
    with _text_partitions(spark):
        return spark.read.format(fmt).load(path)


def log(spark: SparkSession, root: str) -> DataFrame:
    """All log rows; one with a null table stands for each run as such."""
    if not exists(spark, f"{root}/{LOG}"):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/{LOG}")


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, job, seq, committed_at), one row per committed run."""
    runs = log(spark, root).where(F.col("table").isNull())
    return runs.groupBy("run_id").agg(F.min("job").alias("job"), F.min("seq").alias("seq"),
                                      F.min("committed_at").alias("committed_at"))


def is_committed(spark: SparkSession, root: str, run_id: str) -> bool:
    return not log(spark, root).where(F.col("table").isNull() & (F.col("run_id") == run_id)).isEmpty()


def _parts(spark: SparkSession, root: str, table: str, run_id: str, by: Sequence[str], fmt: str) -> DataFrame | None:
    """(table, by, part) of what a run staged of a table."""
    rows = staged_rows(spark, root, table, run_id, fmt)
    if rows is None:
        return None
    if by:
        parts = rows.select(F.array(*[F.col(c).cast("string") for c in by]).alias("part")).distinct()
    else:
        parts = rows.limit(1).select(F.array(F.lit(run_id)).alias("part"))
    return parts.select(F.lit(table).alias("table"), F.array(*[F.lit(c) for c in by]).cast("array<string>").alias("by"), "part")


def _append(spark: SparkSession, root: str, rows: DataFrame, run_id: str, job: str, removed: bool = False) -> None:
    seq = log(spark, root).agg(F.max("seq")).first()[0]
    head = spark.range(1).select(F.lit(None).cast("string").alias("table"), F.lit(None).cast("array<string>").alias("by"),
                                 F.lit(None).cast("array<string>").alias("part"))
    out = head.unionByName(rows).select(
        F.lit(run_id).alias("run_id"), F.lit(job).alias("job"), F.lit(0 if seq is None else seq + 1).cast("bigint").alias("seq"),
        F.current_timestamp().alias("committed_at"), "table", "by", "part", F.lit(removed).alias("removed"))
    out.repartition(1).write.mode("append").parquet(f"{root}/{LOG}")   # one file: it is there or it is not


def commit(spark: SparkSession, root: str, run_id: str, job: str, tables: Mapping[str, Sequence[str]],
           formats: Mapping[str, str] | None = None) -> bool:
    """Makes all that the run staged visible: ``tables`` gives each table's partition columns. False if
    the run had been committed before, when nothing changes."""
    if is_committed(spark, root, run_id):
        return False
    rows = spark.createDataFrame([], "table string, by array<string>, part array<string>")
    for table, by in tables.items():
        parts = _parts(spark, root, table, run_id, by, (formats or {}).get(table, "parquet"))
        rows = rows if parts is None else rows.unionByName(parts)
    _append(spark, root, rows, run_id, job)
    return True


def _newest(entries: DataFrame) -> DataFrame:
    """(part, run_id, by, removed, seq, committed_at): the entry that counts for each partition."""
    order = F.struct("seq", "committed_at", "run_id")
    return entries.groupBy("part").agg(F.max_by(F.struct("run_id", "by", "removed", "seq", "committed_at"), order)
                                       .alias("w")).select("part", "w.*")


def live_parts(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(part, run_id, ..) of the partitions that readers see."""
    return _newest(log(spark, root).where(F.col("table") == table)).where(~F.col("removed"))


def read(spark: SparkSession, root: str, table: str, run_id: str | None = None, fmt: str = "parquet") -> DataFrame | None:
    """The committed rows of a table, each partition from the run that committed it last; None if
    there are none. With ``run_id`` that run's staged rows count as committed last of all."""
    entries = log(spark, root).where(F.col("table") == table)
    by = entries.select("by").first()
    if run_id is not None:
        own = staged_rows(spark, root, table, run_id, fmt)
        if own is not None and by is not None:
            own = _parts(spark, root, table, run_id, by["by"], fmt)
            entries = entries.unionByName(own.select(
                F.lit(run_id).alias("run_id"), F.lit("").alias("job"), F.lit((1 << 62)).cast("bigint").alias("seq"),
                F.current_timestamp().alias("committed_at"), "table", "by", "part", F.lit(False).alias("removed")))
        elif own is not None:
            return own
    if by is None or not exists(spark, f"{root}/{table}", fmt):
        return None
    with _text_partitions(spark):
        data = spark.read.format(fmt).load(f"{root}/{table}")
    live = _newest(entries).where(~F.col("removed")).select(
        F.col("run_id").alias("mf_live"), *[F.col("part")[i].alias(f"mf_part_{i}") for i in range(len(by["by"]))])
    on = F.col(RUN) == F.col("mf_live")
    for i, c in enumerate(by["by"]):
        on = on & F.col(c).eqNullSafe(F.col(f"mf_part_{i}"))
    return data.join(live, on, "left_semi").drop(RUN)


# ---------------------------------------------------------------- retention

def batch_ts(part: Column) -> Column:
    """Time of a ``yyyyMMdd_HHmmss`` batch id."""
    return F.try_to_timestamp(part, F.lit("yyyyMMdd_HHmmss"))


def expire(spark: SparkSession, root: str, table: str, days: int, as_of, batch: str = "batch_id") -> str:
    """Commits the removal of the partitions whose batch is older than ``days`` before ``as_of`` (S10);
    returns the run. Their files stay until ``vacuum``."""
    at = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    live = live_parts(spark, root, table)
    index = F.array_position("by", batch)
    old = live.where(index > 0).where(batch_ts(F.get("part", (index - 1).cast("int"))) < at - F.make_dt_interval(F.lit(days)))
    run = new_run()
    _append(spark, root, old.select(F.lit(table).alias("table"), "by", "part"), run, "expire", removed=True)
    return run


def _delete(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, seconds since the epoch of the newest file below) of the folders in ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    out = []
    for f in fs.listStatus(where):
        if f.isDirectory():
            newest, files = f.getModificationTime(), fs.listFiles(f.getPath(), True)
            while files.hasNext():
                newest = max(newest, files.next().getModificationTime())
            out.append((f.getPath().getName(), newest / 1000))
    return out


def vacuum(spark: SparkSession, root: str, table: str, grace_seconds: float = 86_400) -> int:
    """Deletes folders of a table that no reader reaches: partitions replaced or removed by a commit
    ``grace_seconds`` ago, and runs without a commit whose newest file is as old. Returns how many.
    Only folder names reach the driver, one at a time where there may be many."""
    runs = {r["run_id"] for r in log(spark, root).where(F.col("table") == table).select("run_id").distinct().toLocalIterator()}
    now = spark.sql("SELECT unix_micros(current_timestamp()) / 1e6").first()[0]
    gone = 0
    for name, newest in _folders(spark, f"{root}/{table}"):
        run = name.removeprefix(f"{RUN}=")
        if name != run and run not in runs and newest <= now - grace_seconds:
            gone += _delete(spark, f"{root}/{table}/{name}")
    mine = log(spark, root).where(F.col("table") == table)
    winner = _newest(mine).select(F.col("part").alias("w_part"), F.col("run_id").alias("w_run"),
                                  F.col("committed_at").alias("w_at"), F.col("removed").alias("w_removed"))
    dead = mine.where(~F.col("removed")).join(winner, F.col("part") == F.col("w_part")).where(
        ((F.col("run_id") != F.col("w_run")) | F.col("w_removed"))
        & (F.unix_micros("w_at") / 1e6 <= F.lit(now) - F.lit(grace_seconds)))
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for r in dead.select("run_id", "by", "part").distinct().toLocalIterator():
        below = "".join(f"/{escape(c, v)}" for c, v in zip(r["by"], r["part"]))
        gone += _delete(spark, run_path(root, table, r["run_id"]) + below)
    return gone


def compact_log(spark: SparkSession, root: str) -> None:
    """Folds the log's files into one. The folded file is added before the others go, and rows
    that a reader meets twice meanwhile are alike, which changes no result."""
    rows = log(spark, root)
    old = rows.inputFiles()
    if len(old) > 1:
        rows.distinct().repartition(1).write.mode("append").parquet(f"{root}/{LOG}")
        for f in old:
            _delete(spark, f)

"""Scans, file discovery and sinks.

Tables are Parquet partitioned by ``batch_id`` with dynamic partition
overwrite, so rerunning a batch replaces exactly its partition (idempotent),
and a filter on ``batch_id`` prunes partitions at planning time. CSV and JSON
remain as exchange formats. Paths are shared-storage folders; nothing is
written to a machine-local temp folder.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# File name prefixes of the reference's raw and processed files.
QUOTES_PREFIX = "stock_quotes_"
HISTORICAL_PREFIX = "stock_historical_"
BATCH_PATTERN = r"_(\d{8}_\d{6})\.csv$"


def write_table(df: DataFrame, path: str, batch: str | Sequence[str] = "batch_id", fmt: str = "parquet") -> None:
    """Partitioned write; reruns replace only the batches they contain.
    An empty frame writes no partition (F16)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*([batch] if isinstance(batch, str) else batch)).format(fmt).options(**({"header": "true"} if fmt == "csv" else {}))
       .save(path))


def clustered(df: DataFrame, batch: str | Sequence[str] = "batch_id", by: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Rows laid out for data skipping: range-partitioned and sorted by batch and ``by`` (a series, then its
    order, so that a hot series still spreads over many ranges). Files and row groups then hold
    narrow ranges of the first column, which their Parquet statistics let a filter skip."""
    order = [F.col(c) for c in [*([batch] if isinstance(batch, str) else batch), *by] if c in df.columns]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def skipping_options(column: str = "symbol", row_group_bytes: int = 16 << 20, distinct: int | None = None) -> dict[str, str]:
    """Parquet writer options for ``clustered`` rows: small row groups, and a Bloom filter on ``column`` for
    filters on values inside a row group's range that it does not hold."""
    out = {"parquet.block.size": str(row_group_bytes), f"parquet.bloom.filter.enabled#{column}": "true"}
    return out | ({f"parquet.bloom.filter.expected.ndv#{column}": str(distinct)} if distinct else {})


def write_clustered(df: DataFrame, path: str, batch: str | Sequence[str] = "batch_id", by: Sequence[str] = ("symbol", "date"),
                    **options) -> None:
    """``write_table`` of ``clustered`` rows with Bloom filters on the first of ``by``."""
    (clustered(df, batch, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*([batch] if isinstance(batch, str) else batch)).options(**skipping_options(by[0], **options)).parquet(path))


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet", glob: str | None = None) -> DataFrame:
    """Scan a table with an explicit schema (S01); ``glob`` filters file names."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true").option("mode", "PERMISSIVE")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def file_path() -> Column:
    """Path of the file that a row was scanned from, as it is named (``_metadata`` has it URI-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def header_groups(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.csv") -> dict[str, list[str]]:
    """Header line -> files that have it. Only first lines are kept; what reaches
    the driver is one path per file."""
    lines = spark.read.option("pathGlobFilter", glob).text(paths).select(
        "value", file_path().alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("i"))
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "i").alias("header"))
    out: dict[str, list[str]] = {}
    for r in first.collect():
        out.setdefault(r["header"], []).append(r["file"])
    return out


def read_raw_batches(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                     glob: str = "*.csv") -> tuple[DataFrame, DataFrame]:
    """Raw CSV batches -> (good rows, quarantined rows).

    Columns are taken by the name in each file's header, in whatever order;
    a column that a header lacks is null, one that the schema lacks is ignored.
    The file name gives ``kind``/``batch_id`` (S04). Malformed lines are kept
    by the PERMISSIVE reader in a corrupt-record column and routed to the
    quarantine side instead of failing the job; every other batch and row
    continues. A batch with no good row simply has no output partition.
    The parsed scan is written once to the shared checkpoint folder (Spark
    does not allow later projections of raw CSV that keep only the corrupt
    record column), and both sides read that table.
    """
    bad_col = "_corrupt_record"
    types = {f.name: f.dataType for f in schema.fields}
    parts = []
    for header, files in header_groups(spark, paths, glob).items():
        names = [n.strip() for n in next(csv.reader([header]), [])]
        fields = [(n, types[n]) if n in types and n not in names[:i] else (f"_mf_other_{i}", T.StringType())
                  for i, n in enumerate(names)]
        full = T.StructType([T.StructField(n, t) for n, t in fields] + [T.StructField(bad_col, T.StringType())])
        df = (spark.read.schema(full).option("header", "true").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", bad_col).csv(files))
        name = F.regexp_extract(file_path(), r"([^/]+)$", 1)
        known = {n for n, _ in fields}
        parts.append(df.select(
            *[F.col(n) if n in known else F.lit(None).cast(t).alias(n) for n, t in types.items()], bad_col,
            parse_batch(name).alias("_mf_b"), name.alias("file_name")))
    if not parts:
        empty = T.StructType([*schema.fields, T.StructField(bad_col, T.StringType()), T.StructField("file_name", T.StringType())])
        parts = [spark.createDataFrame([], empty).withColumn("_mf_b", parse_batch(F.col("file_name")))]
    df = materialize(union_batches(*parts), "raw-batches")
    good = df.where(F.col(bad_col).isNull()).select(
        *[F.col(f.name) for f in schema.fields], F.col("_mf_b.kind").alias("kind"),
        F.col("_mf_b.batch_id").alias("batch_id"))
    # ``parsed``: JSON of the fields that did parse - one schema for every
    # kind of file, and Spark refuses scans of the corrupt record column alone
    bad = df.where(F.col(bad_col).isNotNull()).select(
        "file_name", F.col("_mf_b.kind").alias("kind"), F.col("_mf_b.batch_id").alias("batch_id"),
        F.col(bad_col).alias("record"), F.to_json(F.struct(*[F.col(f.name) for f in schema.fields])).alias("parsed"))
    return good, bad


def write_summary(df: DataFrame, path: str) -> None:
    """JSON sink for run summaries."""
    df.write.mode("append").json(path)


def read_summary(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON scan of whole documents."""
    r = spark.read.option("multiLine", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def parse_batch(name: Column) -> Column:
    """File name -> struct(kind, batch_id, batch_ts).

    The batch id is the full ``yyyyMMdd_HHmmss`` stamp (the reference kept
    only the time part of processed names, so ids never matched)."""
    bid = F.regexp_extract(name, BATCH_PATTERN, 1)
    bid = F.when(bid != "", bid)
    kind = F.when(name.contains(QUOTES_PREFIX), F.lit("quotes")).otherwise(F.lit("historical"))
    return F.struct(kind.alias("kind"), bid.alias("batch_id"),
                    F.try_to_timestamp(bid, F.lit("yyyyMMdd_HHmmss")).alias("batch_ts"))


def list_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """File discovery as a DataFrame of names (S03) - distributed listing via
    the binary-file source, reading no content."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
                 .select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                         F.col("modificationTime").alias("mtime")))


def union_batches(*dfs: DataFrame) -> DataFrame:
    """one table from per-batch (or per-symbol) frames whose columns may
    differ: union by name, missing columns null. A plan-level union - no
    shuffle, each input keeps its own partitions."""
    if not dfs:
        raise ValueError("union_batches needs at least one frame")
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def pending_batches(raw: DataFrame, done: DataFrame, keys: Sequence[str] = ("kind", "batch_id")) -> DataFrame:
    """Raw batches not yet processed: anti-join on (kind, batch_id)."""
    return raw.select(*keys).distinct().join(done.select(*keys), list(keys), "left_anti")


def retain(df: DataFrame, days: int, as_of, ts: str = "batch_ts") -> DataFrame:
    """Keep rows no older than ``days`` before ``as_of``."""
    ref = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return df.where(F.col(ts) >= ref - F.make_dt_interval(F.lit(days)))

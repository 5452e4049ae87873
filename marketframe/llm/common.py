"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, materialize

#: ASCII white space, the only word separators of these operators (fixed values).
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


#: Settings while a table is staged: its query's shuffle files go when it has ended, as the
#: table needs them no more, and batches sent to Python are bounded by bytes, as texts may be long.
_STAGING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back, so
    that later passes (and lost executors) re-read it instead of recomputing. The
    shuffle files behind it are removed as soon as it is written."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in _STAGING}
    for k, v in _STAGING.items():
        conf.set(k, v)
    try:
        return materialize(df, f"llm-{name}")
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def unstage(df: DataFrame) -> None:
    """Deletes the folder of a table that ``stage`` wrote and nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (bound as a lambda
    variable), where a plain reference would be evaluated again in every use."""
    return F.transform(F.array(value), body)[0]


def id_crc32(id_col: str) -> Column:
    """crc32 of an id written as decimal text; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def packers(n_rows: int, per_task: int) -> int:
    """Tasks needed for ``n_rows`` at ``per_task`` rows each, one at least."""
    return max(1, -(-n_rows // per_task))

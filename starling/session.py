"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and benches on one machine. A cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starling")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Small tables still feed all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _scratch_of(spark: SparkSession) -> str:
    """The folder of this application under the shared folder the cluster names in spark.checkpoint.dir.

    Only a local master, which has no other machine, may do without that setting.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="starling-")
        base = _LOCAL_SCRATCH[app]
    return f"{base.rstrip('/')}/{app}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for something that plans read again."""
    return f"{_scratch_of(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that the plans of this application have stored. Their results must not be read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch_of(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether there is something at the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path or "/")
    return bool(path) and place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read many times.

    Used where several branches of a plan read the same costly input. Parquet, so each branch still prunes
    its columns and pushes its filters, and a lost executor costs a re-read and not a re-run. What the job shuffled is of
    no use once it is written, so its shuffle files go when it ends.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Sequence[Sequence], /, **types: pa.DataType) -> DataFrame:
    """A table of a few literal rows. Its size is known to the optimizer, unlike that of rows sent as objects."""
    columns = [[row[i] for row in rows] for i in range(len(types))]
    arrays = [pa.array(values, kind) for values, kind in zip(columns, types.values(), strict=True)]
    return spark.createDataFrame(pa.table(arrays, names=list(types)))

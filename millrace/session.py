"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the library depends on for correct results (UTC timestamps) and for
# scale (AQE re-planning, skew splitting, partition coalescing).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State of streaming jobs lives on disk, with map state and timers.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "millrace") -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide; locally tests pass ``local[N]``."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    There is no fallback: a machine-local folder would be a different one on every executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared checkpoint folder for a written intermediate table."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: what is used twice is computed once, and a
    lost executor costs a read, not the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shared: dict[tuple, object] = {}


def shared(df: DataFrame, key: tuple, build):
    """``build()`` once an application and ``key``. The result is used again only while path, length and time of
    every file that ``df`` reads stay the same."""
    spark, files = df.sparkSession, df.inputFiles()
    if not files:
        return build()
    state = spark.read.format("binaryFile").load(files).agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()[0]
    full = (spark.sparkContext.applicationId, *key, state)
    if full not in _shared:
        _shared[full] = build()
    return _shared[full]


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package, once an application (what ``--py-files`` does), so that functions
    found by name can be imported on executors that do not have the repository. The archive lies with the driver,
    Spark hands it to the executors."""
    sc, package = spark.sparkContext, Path(__file__).resolve().parent
    if sc.applicationId in _shipped or not package.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="millrace-code-")) / "millrace.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)

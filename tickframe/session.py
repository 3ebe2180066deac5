"""Spark session factory and the shared checkpoint folder.

On a cluster the session already carries ``spark.checkpoint.dir`` (a shared
folder); we only read it. A folder of our own is set only when the setting is
absent, which is the case for local tests.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickframe") -> SparkSession:
    """Return the active session or build one tuned for this library.

    AQE stays on: it coalesces small shuffle partitions, splits skewed join
    partitions and turns a sort-merge join into a broadcast only after it has
    measured the real size of the small side.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return tune_session(active)
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TICKFRAME_DRIVER_MEMORY", "8g"))
    )
    if not SparkConf().get("spark.checkpoint.dir", None):
        # Local runs only: spark-submit on a cluster passes the shared folder.
        builder = builder.config("spark.checkpoint.dir",
                                 local_scratch(master or f"local[{cpus}]"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune_session(spark)
    return spark


def tune_session(spark: SparkSession) -> SparkSession:
    """Runtime settings the library relies on; safe on any existing session.

    Feature plans carry ~100 aliased window columns; Catalyst's constraint
    propagation grows quadratically in them and stalls the optimizer once
    such a plan is joined (class weights, key sizes), so it is switched off.
    Filters are still pushed down (that is a separate rule).
    """
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for ``checkpoint()`` and written intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local master may go without that
    setting: it gets a fresh folder under the system temp area. A cluster
    without it is an error, as executors cannot see a driver-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = local_scratch(sc.master)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def local_scratch(master: str) -> str:
    """A temp folder for a ``local`` / ``local[n]`` master; raises for any other."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master!r}")
    return tempfile.mkdtemp(prefix="tickframe-ckpt-")


_written: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, deleted when the driver ends."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _written[path] = spark
    return path


def scratch_table(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut the lineage: write ``df`` as parquet in the shared folder and read it back.
    ``options``: of the writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete the folder of a ``scratch_table`` that nothing reads any more."""
    if (spark := _written.pop(getattr(df, "_scratch", None), None)) is not None:
        _delete(spark, df._scratch)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session may be gone already
        pass


def drop_scratch(prefix: str = "") -> None:
    """Delete the intermediate folders this process wrote whose name starts with ``prefix``."""
    for path in list(_written):
        if not os.path.basename(path).startswith(prefix):
            continue
        _delete(_written.pop(path), path)


atexit.register(drop_scratch)

"""Session helpers: a configured SparkSession and a reliable checkpoint folder."""
from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "podium", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` and let the
    launcher decide; tests use ``local[*]`` with few shuffle partitions."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:      # else the launcher's setting holds
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only a local
    master without the setting gets a private temporary folder (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        conf_dir = tempfile.mkdtemp(prefix="podium-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable (shared-storage) checkpoint so later jobs
    see exactly the rows earlier jobs counted, even after executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name)


#: For tables of few rows of megabytes each: readers hold one row group at a time.
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "4", "parquet.page.size.row.check.max": "4"}


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder; it reads back the same rows."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def conf_set(spark: SparkSession, values: dict[str, str]):
    """Within, these settings hold."""
    was = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_dropped(spark: SparkSession):
    """Within, the shuffle files of a query go as soon as it ends."""
    return conf_set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``podium`` importable in Python workers (the ``--py-files``
    mechanism): zip the package once per application and add it to the
    context. Operators that run Python in tasks call this first."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="podium-pyfiles-"), "podium.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)

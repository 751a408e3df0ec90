"""Session helpers: a configured local session and the shared scratch folder.

Everything that has to outlive one job (per-round graph state, keyed sink
output, streaming checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``. Only a local-mode session without that setting gets
a private folder, which is what tests and the bench use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Scratch locations of the ``distilled`` call that is running.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def build_session(
    app: str = "cliqueflow",
    cpus: int | str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session with the settings every stage expects (UTC, AQE, no UI)."""
    master = f"local[{cpus}]" if cpus else "local[*]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder (``spark.checkpoint.dir``).

    Read from the session; a private folder is created only for a local-mode
    session that has none, never on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cliqueflow-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique location below the shared folder, owned by the ``distilled`` call that is running, if any."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


def materialize(df: DataFrame, tag: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` as parquet under the shared folder; return the re-read table and its path.

    One computation, durable against executor loss, and the re-read carries
    real file sizes that the planner uses for its join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def cut_lineage(df: DataFrame, tag: str = "stage") -> DataFrame:
    """``materialize`` without the path."""
    return materialize(df, tag)[0]


def distilled(spark: SparkSession, build: Callable[[], DataFrame], tag: str = "stage") -> DataFrame:
    """The table that ``build`` returns, stored; every other scratch location made by ``build`` is dropped.

    Calls nest: the stored table belongs to the enclosing call, if there is one.
    """
    outer = _OWNED.get()
    token = _OWNED.set(mine := [])
    try:
        out, path = materialize(build(), tag)
        mine.remove(path)
        if outer is not None:
            outer.append(path)
        return out
    finally:
        _OWNED.reset(token)
        for path in mine:
            drop_path(spark, path)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path`` (file-system metadata only, no scan)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def finished_parts(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` that a finished write left (with its ``_SUCCESS``), sorted; none if there is no ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]
    return sorted(n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch location through the Hadoop file system of the session."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hpath, True)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per context, wherever the session runs."""
    sc = spark.sparkContext
    name = f"{__package__}-src.zip"
    if any(os.path.basename(p) == name for p in sc._python_includes):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="cliqueflow-src-")  # read by the driver's file server only
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w") as out:
        for at, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(at, f)
                    out.write(full, os.path.join(__package__, os.path.relpath(full, root)))
    sc.addPyFile(path)

"""Session helpers: shipping the package to executors, shared checkpoints."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_own_folder: str | None = None


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Arrow functions find it there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{sc.applicationId}/millrace.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(path.toString())
    _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir; only where none is set and all run on this machine, as in tests, a temporary one."""
    global _own_folder
    set_one = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_one:
        return set_one.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    _own_folder = _own_folder or "file://" + tempfile.mkdtemp()
    return _own_folder


def spread(df: DataFrame, by: str | None = None, small: int = 64 << 20) -> DataFrame:
    """A table of a few small files over all cores: such a file is one task, however many cores wait. Larger tables stay as they are.

    `by` keeps equal values together, so that what a task remembers of them serves."""
    spark = df.sparkSession
    n, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if not files or len(files) >= n:
        return df
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    size = 0
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(f)
        size += path.getFileSystem(conf).getFileStatus(path).getLen()
    return df if size > small else df.repartition(n, by) if by else df.repartition(n)


def cut(df: DataFrame) -> DataFrame:
    """The rows of df written to the shared folder, so that lost executors don't lose them."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)

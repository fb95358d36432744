"""Sessions, tables and the shared folder that cuts lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None


def build_session(app: str = "granary", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library expects; a running one is reused."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


# Tables of texts: their rows cost far more to process than to move.
TEXT_TABLES = ("data_pipeline", "documents")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where the scan gives fewer partitions than half of them, as a file of one row group
    does; a table with enough splits is not moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir``. Only where the session names none
    (tests on one machine) a temporary folder of this process is used."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="granary-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return "file://" + _own_dir


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: the lineage ends there and
    losing an executor loses nothing. The table is removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/granary-{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", compression).parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._granary_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table of ``materialize`` that nothing will read again, as those of past rounds."""
    path = getattr(df, "_granary_path", None)
    if path:
        _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    if path.startswith("file://"):
        shutil.rmtree(path[len("file://"):], ignore_errors=True)
        return
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone
        pass


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package known to the Python workers of a session, once. Needed where it is neither installed on
    the executors nor on their path; Spark sends the archive itself."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="granary-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "granary_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for here, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(here, f)
                    z.write(full, os.path.join("granary", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)

"""Session construction and the shared scratch folder.

Nothing in the library changes a running session's settings for good: cluster
sizing (shuffle partitions, split sizes, broadcast threshold) belongs to the
submitter.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "frameloom", **conf: str) -> SparkSession:
    """A UTC session with AQE on, for tests, benches and notebooks."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only where the setting is absent (tests on one machine) a temporary folder
    is made and put into the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="frameloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of a location, through the session's Hadoop settings."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_tree(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


_scratch: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root, removed when the driver ends."""
    d = f"{shared_root(spark)}/frameloom/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, d))
    return d


def cut(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    The lineage ends there, and a lost executor costs a re-read, not a re-run.
    """
    d = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(d)
    return spark.read.schema(df.schema).parquet(d)


@atexit.register
def _clean() -> None:
    for spark, d in _scratch:
        try:
            remove_tree(spark, d)
        except Exception:  # noqa: BLE001 - the session may be gone already
            return

"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the library relies on. All of them can be set on a live
# session, so they also reach a session that somebody else has built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hot users and items are expected: split a skewed join side even where
    # that costs one more exchange behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application: kernels run there import it."""
    sc = spark.sparkContext
    if getattr(sc, "_marquee_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="marquee-"), "marquee.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._marquee_shipped = True


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's settings to the session, for good, and send the package to the executors."""
    ship(spark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "marquee") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; without that setting a folder that the
    application gave to ``setCheckpointDir`` serves. Only a local session that has neither gets
    a temporary folder of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
        return folder.rstrip("/")
    if sc.getCheckpointDir() is not None:  # set by the application itself
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def uri(path: str) -> str:
    """A folder as a URI that pyarrow can open: Hadoop writes local ones with one slash or with none of the scheme."""
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path.removeprefix("file:")
    return path if "://" in path else f"file://{path}"


def forget(spark: SparkSession, every: float = 5.0) -> None:
    """Let Spark's cleaner remove the shuffle files of plans that nothing refers to any more.

    The cleaner learns of them from the driver's garbage collection, which a driver with little to do
    rarely has: the files of a finished plan would stay on disk beside those of all later ones. The plan that has
    just run is let go a moment after its end, hence the second collection.
    """
    sc = spark.sparkContext
    if time.monotonic() - getattr(sc, "_marquee_forgot", float("-inf")) >= every:
        gc.collect()
        sc._jvm.System.gc()
        time.sleep(0.3)
        sc._jvm.System.gc()
        sc._marquee_forgot = time.monotonic()


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Used where several later passes read the same derived table: each pass then
    scans only the columns it needs, and a lost executor costs no recomputation
    of the joins behind the table, whose shuffle files are given up.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    forget(spark)
    return spark.read.schema(df.schema).parquet(path)


def deal(df: DataFrame, keys: Sequence[str], rows: int = 1 << 20) -> DataFrame:
    """The rows placed by their unique ``keys`` alone, about ``rows`` to a partition and at least 8 partitions.

    Bagging and block placement draw per partition. With this placement a seed gives the same model
    on any number of cores, whatever the files looked like.
    """
    parts = max(8, -(-df.count() // rows))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys)

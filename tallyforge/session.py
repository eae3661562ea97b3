"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import gc
import io
import os
import tempfile
import threading
import time
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Spark's switch for shuffle files that go with the execution that made them.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", app: str = "tallyforge", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster, bring your own."""
    parallel = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    ``spark.checkpoint.dir`` wins. A temporary folder is made only for a local
    master, where driver and executors share one disk by definition.
    """
    sc = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY) or sc.getCheckpointDir()
    if base:
        return base
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    base = tempfile.mkdtemp(prefix="tallyforge-")
    sc.setCheckpointDir(base)
    return base


def ensure_checkpoint(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable."""
    base = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tallyforge/{label}-{uuid.uuid4().hex}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Actions in here take their shuffle files away when they are done. Elsewhere these stay
    until the driver happens to collect its garbage. A frame that is run again makes them anew."""
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner see what nothing refers to any more: it takes away shuffle files,
    persisted parts and, where the session allows it, checkpoints. Python's references end a
    moment after they are given up, in a thread of their own, so it looks twice."""
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()


@contextmanager
def releasing(spark: SparkSession, every: float = 10.0) -> Iterator[None]:
    """``release`` now and then during a long call into Spark, and at its end."""
    over = threading.Event()

    def run() -> None:
        while not over.wait(every):
            spark.sparkContext._jvm.System.gc()

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
    release(spark)


def written(df, label: str):
    """Write once as Parquet below the shared folder and read it back.

    For results used several times: later stages read columns from storage, the
    lineage ends here, and Spark knows the real size when it plans a join. What was
    shuffled on the way is gone afterwards.
    """
    path = fresh_path(df.sparkSession, label)
    with tidy(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(df) -> None:
    """Takes the files of a frame of ``written`` away. Nothing that is still to be computed may read them."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._written_at)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, so that Arrow functions find their modules wherever the
    driver was started. Spark copies the archive; no path has to be shared."""
    sc = spark.sparkContext
    if getattr(sc, "_tallyforge_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in sorted(os.walk(os.path.join(top, "tallyforge"))):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, top))
    path = os.path.join(sc._temp_dir, "tallyforge.zip")
    with open(path, "wb") as file:
        file.write(packed.getvalue())
    sc.addPyFile(path)
    sc._tallyforge_shipped = True

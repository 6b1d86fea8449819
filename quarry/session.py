"""Session helpers.

The library never creates a cluster session on its own; tests and ``bench.py``
use :func:`local_session`.  Lineage cuts go to ``spark.checkpoint.dir`` as the
cluster names it; a private folder is made only when that setting is unset and
the master is local.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # a checkpoint goes when its frame does; clusters set the same
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  Only a local master may
    fall back to a fresh private folder (tests); on a cluster the setting is
    required, because a machine-local folder would not survive executor loss.
    """
    already = spark.sparkContext.getCheckpointDir()
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not path and already:
        return already
    if not path:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if already is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss.

    The frame is persisted first so writing the checkpoint reads the cached
    blocks instead of computing the plan a second time."""
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a compressed table below the checkpoint folder, and read
    from there: the same cut of lineage on a fraction of the disk, and nothing is
    cached meanwhile.  Readers take only the columns they need.  The files go
    when the application ends."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"stored-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable on every executor (what ``--py-files`` does):
    the Arrow UDFs pickle references to functions of this package.  Zips the
    package once per application and adds it with ``addPyFile``; Spark's file
    server distributes it.  A no-op without a classic SparkContext."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # remote session: code must already be on the executors
        return
    if app in _SHIPPED:
        return
    import shutil

    import quarry

    pkg = os.path.dirname(os.path.abspath(quarry.__file__))
    base = tempfile.mkdtemp(prefix="quarry-pyfiles-")
    archive = shutil.make_archive(os.path.join(base, "quarry"), "zip", root_dir=os.path.dirname(pkg), base_dir="quarry")
    sc.addPyFile(archive)
    _SHIPPED.add(app)

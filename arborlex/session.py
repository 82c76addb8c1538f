"""Session helpers: building a local session for tests and bench, and lineage cuts.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A local default is set only when the setting
is absent (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Shuffle files of an execution are removed at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "arborlex") -> SparkSession:
    """Local session used by tests and bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A scratch folder is created only when the setting is absent and the session is local (tests
    and bench); on a cluster the setting must name a folder that all executors share.
    The folder is registered with the context once; without a reachable context
    (Spark Connect) the server-side setting is used as it is.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: checkpoints go where the server is configured
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="arborlex-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, dealt: bool = False) -> DataFrame:
    """Reliable checkpoint in the shared checkpoint folder (survives executor loss).

    With ``dealt`` the plan runs as it stands (an adapted plan doesn't tell how its rows lie), so that readers know by what keys the
    rows are partitioned and sorted and don't shuffle them again.  The shuffle files of the plan go when the checkpoint stands.
    """
    ensure_checkpoint_dir(df.sparkSession)
    conf = df.sparkSession.conf
    settings = {CLEANUP: "true", **({"spark.sql.adaptive.enabled": "false"} if dealt else {})}
    before = {key: conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            conf.set(key, value)
        return df.select("*").checkpoint(eager=True)  # planned under these settings
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def release(*cuts: DataFrame) -> None:
    """Removes the files of checkpoints (as :func:`cut_lineage` gave them) that nothing reads any more; Spark itself removes them only when
    the driver collects its garbage, so that the folder holds every step of a query.  Without a reachable context they stay."""
    for df in cuts:
        try:
            sc, rdd = df.sparkSession.sparkContext, df._jdf.queryExecution().analyzed().rdd()
        except Exception:  # Spark Connect, or no checkpoint
            continue
        file = rdd.getCheckpointFile()
        if file.isDefined():
            path = sc._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def bounded(df: DataFrame) -> DataFrame:
    """``df`` as it is, with the session's Arrow batches bounded in rows and bytes: a Python worker holds a
    batch or two, so its memory must not grow with the length of texts."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 2000),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        held = conf.get(key, None)
        if held is None or not 0 < int(re.sub(r"\D", "", held) or 0) <= most:
            conf.set(key, str(most))
    return df

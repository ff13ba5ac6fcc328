"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "stressframe") -> SparkSession:
    """A local session for tests and the bench; a cluster passes its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage the cluster names; it is
    read from the session, never invented. Only a local-mode session with the
    setting unset gets a fresh folder of its own (tests, the bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at shared storage the cluster can reach"
            )
        conf = tempfile.mkdtemp(prefix="stressframe-ckpt-")
        atexit.register(shutil.rmtree, conf, ignore_errors=True)  # a folder of this process alone
        spark.conf.set(CHECKPOINT_CONF, conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Survives executor loss, unlike cached or locally checkpointed blocks.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_path(df: DataFrame) -> str | None:
    """Where ``cut_lineage`` stored its result."""
    found = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    return found.get() if found.isDefined() else None


def drop_stored(spark: SparkSession, path: str | None) -> None:
    """Remove a stored table of this application that nothing reads any more."""
    if path:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

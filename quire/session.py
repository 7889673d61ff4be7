"""Session set-up, table access and the few things that depend on where Spark runs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "quire", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine expects; a cluster brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers. A cluster may use ``--py-files`` instead."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep) and root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; a private one only where that is unset."""
    sc = spark.sparkContext
    path = sc.getConf().get(CHECKPOINT_KEY)
    if not path and sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="quire-checkpoint-")
    if not path:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder; what is read twice is computed once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Session helpers: table loading, lineage cuts and a local session for tests.

Library code never sets a master or memory size; it works on whatever session
the caller hands in. ``local_session`` exists only for tests, bench and tools.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table; filters and projections applied later
    are pushed into this scan by Catalyst."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a
    local session (one JVM) gets a private folder; on a cluster that would be
    a different disk per machine, so it is an error there.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        one_machine = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
        if not base and not one_machine:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not base:
            base = tempfile.mkdtemp(prefix="panelsmith-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir()
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def cut_lineage(df: DataFrame, name: str = "table", partition_by: tuple | list = ()) -> DataFrame:
    """Materialize ``df`` as a Parquet table in the shared checkpoint folder
    and continue from a scan of it.

    One job writes it (an eager ``checkpoint()`` of an uncached plan would
    compute it twice), the files survive executor loss (unlike a local
    checkpoint), and the scan carries real sizes, so joins against a small
    materialized table can be planned as broadcasts. With ``partition_by`` the
    table is laid out by those columns, so later filters on them read only
    the matching files (partition pruning); the original schema is kept."""
    spark = df.sparkSession
    path = shared_dir(spark, "tables", f"{name}-{uuid.uuid4().hex}")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def bucketed_table(df: DataFrame, name: str, column: str, n: int) -> DataFrame:
    """Like ``cut_lineage``, in ``n`` buckets by ``column``: joins and groups on
    it read the table where it lies, only what joins it is shuffled. The table
    is in the session's catalog only until its scan is planned."""
    spark = df.sparkSession
    name = f"panelsmith_{name}_{uuid.uuid4().hex}"
    df.write.option("path", shared_dir(spark, "tables", name)).bucketBy(n, column).saveAsTable(name, format="parquet")
    table = spark.table(name).select(*df.columns)
    table._jdf.queryExecution().optimizedPlan()
    spark.sql(f"DROP TABLE {name}")
    return table


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that ``cut_lineage`` wrote (without
    ``partition_by``) and that nothing reads any more."""
    context = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "panelsmith") -> SparkSession:
    """Session for tests / bench / tools only."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PANELSMITH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    event_dir = os.environ.get("PANELSMITH_EVENT_LOG")
    if event_dir:
        # stage / task timings for tools/stage_times.py (no UI server involved)
        spark = spark.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = spark.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark

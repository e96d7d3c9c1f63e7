"""Session defaults and the shared scratch location."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "ledgerlight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is tuned for; a cluster's own settings win over these.

    Nothing in the engine depends on them for correct results.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.dataFrameQueryContext.enabled": "false",  # no stack capture per column expression
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go once no plan refers to them
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that driver and executors share: the one the cluster names for checkpoints, else one below the
    warehouse. A folder of one machine is refused where executors run on others."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and warehouse.partition(":")[0] in ("file", warehouse):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; {warehouse} is one of this machine")
    return f"{warehouse}/_checkpoints"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for an intermediate table of one query; the next run of the query overwrites it."""
    return f"{shared_folder(spark).rstrip('/')}/ledgerlight/{spark.sparkContext.applicationId}/{name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared folder, so that a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)

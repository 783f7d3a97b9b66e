"""Session helpers shared by every entry point."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "trackspark", master: str | None = None) -> SparkSession:
    """A session with the settings the operators expect (UTC, AQE, skew joins)."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    return (b.master(master) if master else b).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder all executors share: the one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a single machine uses its temporary folder, a cluster its warehouse.
    """
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if spark.sparkContext.master.startswith("local"):
        return os.path.join(tempfile.gettempdir(), "trackspark-checkpoints")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(spark))
    done = df.checkpoint(eager=True)
    # a checkpointed frame keeps constraints and size estimates of the plan before, which multiply in every round of a loop
    rows = spark._jsparkSession.internalCreateDataFrame(done._jdf.queryExecution().toRdd(), done._jdf.schema(), False)
    return DataFrame(rows, spark)

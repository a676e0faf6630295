"""Where intermediate tables are written, and the session used by tests and bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a scratch folder only for local sessions."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="coldspring-")


class Workspace:
    """Writes intermediate tables as parquet under the checkpoint folder.

    A written table cuts the lineage, survives the loss of executors and keeps
    column pruning and size statistics for the plans that read it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        shared = checkpoint_root(spark)
        self.root = f"{shared}/run-{uuid.uuid4().hex[:12]}"
        self._serial = 0
        # Checkpoints belong to the session and may serve other workspaces: they do not lie in the folder ``close`` removes.
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(f"{shared}/checkpoints")

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return self.stage_at(df, name)[0]

    def stage_at(self, df: DataFrame, name: str) -> tuple[DataFrame, str]:
        """The written table and its folder, for ``remove``."""
        self._serial += 1
        path = f"{self.root}/{self._serial:04d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def remove(self, folder: str) -> None:
        """Remove one written table that no frame reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        """Remove the tables of this workspace. Frames that read them can no longer be used."""
        self.remove(self.root)

    def checkpoint(self, df: DataFrame) -> DataFrame:
        """A reliable checkpoint that keeps the partitioning and order of ``df``, so that later
        groupings on the same key need neither shuffle nor sort. Spark records them only for a
        plan that is fixed before it runs, hence adaptive execution is off for this one job."""
        adaptive = self.spark.conf.get("spark.sql.adaptive.enabled")
        self.spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            return df.checkpoint()
        finally:
            self.spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def local_session(cores: int = 8, partitions: int | None = None, memory: str = "12g",
                  name: str = "coldspring") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(name)
             .config("spark.sql.shuffle.partitions", str(partitions or cores))
             .config("spark.driver.memory", memory)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
             .config("spark.executorEnv.OMP_NUM_THREADS", "1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark

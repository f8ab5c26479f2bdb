"""What jobs need of the cluster: the package on every executor, and tables in the folder that all of it shares."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent


def shipped(spark: SparkSession) -> None:
    """Sends the package along with the job, once a session, unless Python workers find it on their path."""
    home = str(ROOT.parent)
    if home in os.environ.get("PYTHONPATH", "").split(os.pathsep) or os.getcwd() == home:
        return
    context = spark.sparkContext
    if getattr(context, "_lexigraph_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="lexigraph-"), "lexigraph.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(ROOT.rglob("*.py")):
            out.write(path, path.relative_to(ROOT.parent))
    context.addPyFile(archive)
    context._lexigraph_shipped = True


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most this many rows, so that long texts don't fill a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def kernel(f, kind: str):
    """f over Arrow arrays. Called not deterministic so that it runs once, where it stands: filters made of its result would else be
    pushed below it, with a copy of it inside."""
    return F.arrow_udf(f, kind).asNondeterministic()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. Only a session on one machine, as in
    tests, may do without; it uses a local one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = os.path.join(tempfile.gettempdir(), "lexigraph-shared")
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. One that is small (under 64 MB a core) and comes in fewer files than there are cores is
    dealt to all of them; nothing larger is ever exchanged here."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    few = 1 << 20 < size < (cores << 26) and len(df.inputFiles()) < cores
    return df.repartition(cores) if few else df


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, and what it holds survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, for the steps of iterative operators. A checkpoint would keep the size that
    the optimizer has estimated, which multiplies with every join until estimating takes longer than joining."""
    return written(df, "step")

"""Shared storage for intermediate tables, and size-checked broadcasting."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stored size up to which a table is broadcast; in memory it may be several times as large.
BROADCAST_BYTES = 8 << 20
#: Whether a local folder was found to be shared, by application and folder.
_SHARED: dict[tuple[str, str], bool] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors share.

    The folder named in ``spark.checkpoint.dir``. On a cluster one that may lie on the disk of a
    single machine, because it is local and was named without a scheme, is tried out first; where it
    isn't shared, or none is named, a folder in the warehouse is taken, tried out likewise. Where
    a local session names none, it gets one of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = named or context.getCheckpointDir()
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        if folder is None:
            folder = tempfile.mkdtemp(prefix="isospread-")
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if named and spark._jvm.org.apache.hadoop.fs.Path(named).toUri().getScheme() is not None:
        return named.rstrip("/")
    warehouse = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/isospread-scratch"
    tried = [folder.rstrip("/"), warehouse] if folder else [warehouse]
    for place in tried:
        if _is_shared(spark, place):
            return place
    raise RuntimeError(
        f"the executors and the driver share none of {tried}; set spark.checkpoint.dir to a folder "
        "that they share"
    )


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether the driver and other executors see what an executor writes in a folder.

    A remote store is taken to be shared. In a local folder a task for each core writes a file, and
    as many tasks read all of them again: on separate disks the driver lists none, or only those
    of its own machine. It is tried once by an application, on the executors that it has then.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/probe-{uuid.uuid4().hex}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getUri().getScheme() != "file":
        return True
    key = spark.sparkContext.applicationId, folder
    if key not in _SHARED:
        tasks = max(2, spark.sparkContext.defaultParallelism)
        try:
            spark.range(0, tasks, 1, tasks).write.parquet(path.toString())
            seen = spark.read.schema("id LONG").parquet(path.toString()).count()
        except (PySparkException, Py4JError):  # a folder that can't be written, or read elsewhere
            seen = 0
        finally:
            system.delete(path, True)
        _SHARED[key] = seen == tasks
    return _SHARED[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a table in the shared folder, and read it from there.

    Meant for catalogue-sized tables that are both measured and joined: without it the
    measurement and the join would each recompute them. The stored table has no lineage to
    recompute when an executor is lost, and its size is known to the optimizer.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if the optimizer knows it to have at most ``max_bytes``.

    Of a settled frame it knows the stored size, so no job is run. Beyond the bound the frame is
    returned without a hint; Spark then decides, and a shuffled join leaves skewed partitions to
    adaptive execution. The result is the same.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= max_bytes else df

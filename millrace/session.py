"""Session settings and the shared folder that derived tables are written to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Settings a job of this library wants; the cluster's own sizing (executors,
# memory, shuffle partitions) is left to whoever submits it.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Pages and workbooks are wide values: bound an Arrow batch by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}

SPLIT_BYTES = 128 * 1024 * 1024
_SCRATCH = "spark.millrace.folder"


def local_session(cores: str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process; the executors of ``local-cluster`` are not."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a fresh temporary folder; on a cluster
    that folder would exist on one machine, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get(_SCRATCH, "")
    if root:
        return root.rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(_SCRATCH, root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage in a way that survives the loss of executors, and gives
    Catalyst the real size of the result, so whether a later join broadcasts it
    is decided on bytes written and not on a guess.
    """
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_within(spark: SparkSession, most: int) -> Iterator[None]:
    """What is run inside gets Arrow batches of about ``most`` bytes, or of the session's own limit if that is lower.

    A batch ends with the row that reaches the limit. JVM and Python each hold a batch of their own.
    """
    before = spark.conf.get(_BATCH_BYTES, None)
    own = _bytes_of(spark.conf.get(_BATCH_BYTES))
    spark.conf.set(_BATCH_BYTES, str(min(most, own) if own > 0 else most))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES) if before is None else spark.conf.set(_BATCH_BYTES, before)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: the number its own broadcast decision uses."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def _bytes_of(text: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative when broadcasts are off."""
    return _bytes_of(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def fits_broadcast(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)


def sized(df: DataFrame, label: str) -> DataFrame:
    """``df`` in a form whose size Catalyst knows.

    A join side derived from a huge table is estimated as huge, so the other,
    really huge side is shuffled before AQE can see the truth. Where the estimate
    is above the broadcast limit the side is settled first; where it is below, or
    broadcasts are off, it is left alone.
    """
    return df if broadcast_limit(df.sparkSession) < 0 or fits_broadcast(df) else settle(df, label)


def spread(df: DataFrame) -> DataFrame:
    """Give a small input one partition per core before a step that is heavy on CPU.

    Only below one ordinary split per core: larger inputs have enough partitions of
    their own and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_bytes(df) < cores * SPLIT_BYTES else df


def observed(seen: Observation, name: str) -> int | None:
    """A count taken while the data was written; None if the optimizer saw there was no data.

    A plan that is empty by its own text loses its observation together with its scan.
    """
    try:
        return seen.get[name]
    except Py4JJavaError as err:
        if "assertion failed" in str(err.java_exception):
            return None
        raise

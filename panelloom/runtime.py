"""Session-level helpers: shared scratch space, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it is known to have at most this many rows and bytes of text.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Where that is unset and the master is local (tests, a laptop)
    a folder of this machine is made, set as the checkpoint folder and deleted when the session's process ends; on a cluster
    a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="panelloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir("file://" + folder)
    return shared_dir(spark)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, below one folder for the application."""
    return f"{shared_dir(spark)}/panelloom-scratch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def sweep(spark: SparkSession) -> None:
    """Delete this application's scratch tables; call it when no result that rests on them is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/panelloom-scratch/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def swept(spark: SparkSession) -> Iterator[SparkSession]:
    """A span of work whose scratch tables are deleted at its end; results must have been written or collected by then."""
    try:
        yield spark
    finally:
        sweep(spark)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a lineage cut that survives lost executors."""
    path = scratch(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is proven small: at most ``max_rows`` rows and ``max_bytes`` of rendered content.

    The count stops early: no more than ``max_rows + 1`` rows are ever gathered.
    """
    width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its size allows it, else unchanged (a shuffled join with AQE skew splits)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def pick(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns, found by exact name first and else in any case; KeyError for one that isn't there.

    Other columns may have any names, also ones that differ from a wanted name only in case.
    """
    at: dict[int, str] = {}
    for c in columns:
        exact = [i for i, n in enumerate(df.columns) if n == c]
        loose = exact or [i for i, n in enumerate(df.columns) if n.lower() == c.lower()]
        if not loose:
            raise KeyError(f"no column {c}")
        at[loose[0]] = c
    return df.toDF(*[at.get(i, f"_other{i}") for i in range(len(df.columns))]).select(*columns)

"""Session helpers: where scratch tables go and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tablelab.functions.columns import ref


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors, named by ``spark.checkpoint.dir``.

    The setting is left alone where the cluster gives one. Only a local
    session that names none (a test) gets a temporary folder; on a cluster,
    where executors could not read it, an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("tablelab.scratch", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tablelab-")
        spark.conf.set("tablelab.scratch", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, spread_by: Sequence[str] = ()) -> DataFrame:
    """Write the frame once to shared storage and cut its lineage.

    Used before loops that scan the same frame many times. A lost executor
    costs a re-read of the written files, not a recomputation. ``spread_by``
    (a row key) first evens out the partitions, so that no scan of the loop
    waits for one large file or one half-empty filter result; adaptive
    execution picks their number by size: it joins small partitions and cuts
    large ones, whatever the number of shuffle partitions.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(spark))
    if spread_by:
        df = df.hint("rebalance", *[ref(c) for c in spread_by])
    return df.checkpoint(eager=True)


def in_parallel(tasks: Sequence[Callable], parallelism: int) -> list:
    """Run driver functions that submit Spark jobs side by side, results in order."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(lambda task: task(), [inherit(t) for t in tasks])

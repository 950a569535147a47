"""Session-level helpers: the shared folder, tables written to cut lineage, and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if master not in _local_dirs:
        _local_dirs[master] = tempfile.mkdtemp(prefix="syncloom-")
    return _local_dirs[master]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/syncloom/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a table and continue from the files: lineage ends there and the size is known to the planner."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_limit(spark: SparkSession) -> int:
    text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).lower().strip()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = text.removesuffix("b")
    scale = units.get(digits[-1:], 1)
    return int(digits.rstrip("kmg")) * scale


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's own size estimate of ``df`` is within the broadcast threshold."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return False
    size = int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= broadcast_limit(df.sparkSession)


def rereadable(df: DataFrame) -> bool:
    """Whether computing ``df`` again gives the same rows for the cost of a scan: a deterministic projection or filter
    over files, joined to nothing but deterministic results over files. The kind of the sources decides, on both sides of
    a join, never their size. Anything else is written down once.
    """
    if getattr(df, "_jdf", None) is None:
        return False
    node = df._jdf.queryExecution().optimizedPlan()
    while node.deterministic() and node.nodeName() in ("Project", "Filter", "Join"):
        if node.nodeName() == "Join":
            if not _over_files(node.right()):
                return False
            node = node.left()
        else:
            node = node.child()
    return node.deterministic() and _is_files(node)


def _is_files(node) -> bool:  # noqa: ANN001
    return node.nodeName() == "LogicalRelation" and "HadoopFsRelation" in node.relation().getClass().getName()


def _over_files(node) -> bool:  # noqa: ANN001
    """Whether a plan is deterministic and reads files only (or literal rows of the plan itself)."""
    if not node.deterministic():
        return False
    children = node.children()
    below = [children.apply(i) for i in range(children.size())]
    return all(map(_over_files, below)) if below else _is_files(node) or node.nodeName() in ("LocalRelation", "Range", "OneRowRelation")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a directory this library wrote, wherever the path's file system is."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath))


def replace(spark: SparkSession, new: str, path: str) -> None:
    """Put the complete directory ``new`` where ``path`` is; what was there is deleted last."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = f"{path}.old-{uuid.uuid4().hex}"
    if files.exists(hadoop(path)):
        files.rename(hadoop(path), hadoop(old))
    if not files.rename(hadoop(new), hadoop(path)):
        raise OSError(f"cannot move {new} to {path}")
    files.delete(hadoop(old), True)

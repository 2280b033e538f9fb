"""Files a job writes on its way: always in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: list[str] = []
_WRITTEN: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a ``local`` master may do without the setting: there a temporary folder
    of the one machine is as shared as any. On a cluster its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="millrace-"))
    return _LOCAL_ROOT[0]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other job uses."""
    _WRITTEN.append(f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage and fixes non-deterministic columns (partition ids), and
    survives the loss of any executor. Unlike ``checkpoint()`` the copy is
    columnar, so later scans still prune columns and push filters.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written() -> int:
    """A mark: how many paths this session has been given so far."""
    return len(_WRITTEN)


def discard(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Delete what this session wrote through ``fresh_path`` between two marks; all of it without them.

    Frames that read it are void afterwards, and so are marks above ``since``.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _WRITTEN[since:until]
    del _WRITTEN[since:until]
    for name in reversed(paths):
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)

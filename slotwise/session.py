"""Session helpers: shared scratch folder and plan-size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Folders of local sessions that name none, by application.
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the checkpoint folder the cluster names.

    Only a local session that names none gets one of its own; on a cluster a folder of one machine
    would not be seen by the others, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
            spark.sparkContext.setCheckpointDir(_LOCAL_DIRS[app])
        root = _LOCAL_DIRS[app]
    return f"{root.rstrip('/')}/slotwise/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` with a table in the shared folder and read it back."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parse_bytes(text: str) -> int:
    text = text.strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    if text and text[-1] in units:
        return int(text[:-1]) << units[text[-1]]
    return int(text)


def is_broadcastable(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate lies inside the session's broadcast limit.

    Estimates never shrink through filters or joins of unknown selectivity, so a frame
    that grows with the data fails the check and takes the shuffled plan.
    """
    limit = parse_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= limit

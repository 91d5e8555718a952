"""Session helpers: settings, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings that suit these jobs; a session is built with them, the library sets none.
# Timestamps are read in UTC. Wide typed projections make methods that the JVM would
# not compile above 8000 bytes, so Spark should split them instead.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine; on a cluster
    a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.sparkContext.getCheckpointDir()
    )
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        local = tempfile.mkdtemp(prefix="objsync-")
        spark.sparkContext.setCheckpointDir(local)
        return local
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/objsync/{label}-{uuid.uuid4().hex}"

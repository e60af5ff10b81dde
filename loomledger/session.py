"""Session settings the jobs expect, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# The JVM compiles no method above so many bytes of code and interprets it instead.
HUGE_METHOD, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def build_session(app_name: str = "loomledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and times pinned to UTC.

    Only settings that do not depend on the cluster's size are fixed here;
    shuffle parallelism is left to the submitter and to adaptive execution.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Also where an aggregate stands right on the join, at the price of one more exchange.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """For actions on wide expressions: a stage whose one method the JVM would only interpret runs operator by
    operator, whose code Spark splits into small methods. The session's own limit comes back afterwards."""
    before = spark.conf.get(HUGE_METHOD)
    spark.conf.set(HUGE_METHOD, str(COMPILED_BYTES))
    try:
        yield
    finally:
        spark.conf.set(HUGE_METHOD, before)


# Temporary folders of sessions that name no shared one, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path for tables a job writes and reads back.

    The cluster names a folder every executor can reach in
    ``spark.checkpoint.dir``. Where that is unset, a temporary folder is used in
    local mode, where one machine does all work; anywhere else it is an error.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="loomledger-")
        base = _LOCAL_FOLDERS[application]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"

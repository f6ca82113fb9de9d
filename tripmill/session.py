"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that may change while a session runs. Every job calls ``ensure_session`` so that
# results do not depend on the caller's time zone and skewed shuffles are split at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The virtual machine never compiles a method above 8,000 bytes of byte code. Wide trip
    # projections exceed that when fused into one method, and then run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings for sessions this package builds itself; a cluster may override any of them.
BUILD_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def build_session(app: str = "tripmill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the package's settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **BUILD_CONF}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ensure_session(builder.getOrCreate())


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session built elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a temporary one locally."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tripmill-")
    return _local_roots[app]


def workspace(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def table_name(label: str) -> str:
    """A catalog name that nothing has used before."""
    return f"{label}_{uuid.uuid4().hex[:12]}"

"""Session helpers: a local session for tests/bench and the shared scratch root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on (UTC epochs, AQE re-planning, Arrow batches).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.python.filterPushdown.enabled": "true",
}


# Let the JIT compile generated methods above 8 KB (a decode over a large registry
# produces such methods; the JVM would otherwise interpret them).
JIT_FLAG = "-XX:-DontCompileHugeMethods"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "chainsift") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.extraJavaOptions", JIT_FLAG)
        .config("spark.executor.extraJavaOptions", JIT_FLAG)
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_engine_conf(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``chainsift`` importable in the Python workers (UDFs and the data source are
    unpickled there by module name): zip the package once per application and
    ``addPyFile`` it.  Harmless where the package is installed on the cluster."""
    import shutil

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = scratch_root(spark)
    local = root[len("file:"):] if root.startswith("file:") else root
    base = local if os.path.isabs(local) and "://" not in root else tempfile.mkdtemp(prefix="chainsift-pkg-")
    target = os.path.join(base, f"chainsift-pkg-{uuid.uuid4().hex[:8]}")
    archive = shutil.make_archive(target, "zip", root_dir=os.path.dirname(pkg), base_dir="chainsift")
    spark.sparkContext.addPyFile(archive)


def ensure_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the engine needs (cheap, idempotent)."""
    ship_package(spark)
    for k, v in ENGINE_CONF.items():
        try:
            if k == "spark.sql.session.timeZone" or spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static conf on an existing session
            pass
    # Without the JIT flag on the executors, stages whose generated methods exceed the
    # JIT's 8 KB limit run interpreted; then prefer Spark's split per-operator code.
    conf = spark.sparkContext.getConf()
    if JIT_FLAG not in (conf.get("spark.executor.extraJavaOptions", "") or "") or JIT_FLAG not in (
        conf.get("spark.driver.extraJavaOptions", "") or ""
    ):
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's checkpoint dir.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir); only
    when neither is set (local tests) a private directory is created and
    registered as the checkpoint dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="chainsift-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the scratch root (its URI scheme is kept)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"

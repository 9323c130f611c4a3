"""Spark session helpers shared by jobs, queries, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  The time zone keeps
# date_format / to_date free of session-zone shifts, and duplicate JSON keys
# resolve "last wins" like a streaming JSON decoder.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators depend on to ``spark``."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "daybook",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package's required settings.

    On a cluster, leave ``master`` unset and let spark-submit choose it.
    The UI stays off: nothing here needs a web server.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**REQUIRED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Base folder for intermediate tables and staged files.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that is
    used as is.  Only in local mode with nothing configured (tests) a fresh
    folder under the system temp dir is created and registered as the
    checkpoint dir, so later lookups agree; on a cluster a missing setting is
    an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except Exception:      # e.g. a Spark Connect session
        context = None
    if not base and context is not None:
        base = context.getCheckpointDir()
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder every executor can reach; "
                "a machine-local temporary folder is only used in local mode"
            )
        base = tempfile.mkdtemp(prefix="daybook-")
        if context is not None:
            context.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under :func:`shared_dir` for one run's output."""
    return f"{shared_dir(spark)}/daybook/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete one folder made by :func:`scratch_path`, through the cluster's own file system.

    Only paths under this session's scratch root are touched; a session without
    a JVM (Spark Connect) leaves the folder to the cluster's own retention.
    """
    if not path.startswith(f"{shared_dir(spark)}/daybook/"):
        raise ValueError(f"not a scratch folder of this session: {path}")
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

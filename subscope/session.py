"""Session settings and the shared folder for checkpoints and working tables."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold on a laptop and on a large cluster alike. Partition counts are left
# to adaptive execution; broadcast joins keep Spark's own size check.
BASE_CONFIG = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.session.timeZone": "UTC",
}

# Added on a cluster: fewer, larger scan tasks and a wide first shuffle that adaptive
# execution narrows again.
CLUSTER_CONFIG = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.dynamicAllocation.enabled": "true",
    "spark.dynamicAllocation.shuffleTracking.enabled": "true",
}


def session_config(
    app_name: str = "subscope", cluster: bool = False, **overrides: str
) -> dict[str, str]:
    """The settings as a dict; ``overrides`` uses keys with dots, passed by ``**``."""
    config = {"spark.app.name": app_name, **BASE_CONFIG}
    if cluster:
        config.update(CLUSTER_CONFIG)
    config.update(overrides)
    return config


def build_session(config: dict[str, str]) -> SparkSession:
    """A session with the given settings. Only job entry points call this."""
    builder = SparkSession.builder
    for key, value in config.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder; a cluster
    session is refused, since a folder of one machine would be lost with it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    created = tempfile.mkdtemp(prefix="subscope-")
    context.setCheckpointDir(created)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one working table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

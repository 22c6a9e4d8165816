"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .sources.storage import remove_folder

# Set on every session. Parallelism is left to the caller and to AQE: on a cluster start from a large
# ``shuffle_partitions`` and let AQE merge small partitions up to the advisory size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The JVM interprets methods above 8000 bytes of code. A fingerprint over a wide table exceeds that as one method;
    # with this limit Spark splits it into several, which is three times as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    **extra: str,
) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` uses ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the library's settings on a session somebody else built."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def overridden(spark: SparkSession, **settings: str | int) -> Iterator[None]:
    """Run a block with other session settings; ``__`` in a name stands for a dot."""
    names = {name.replace("__", "."): str(value) for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    A local session without that setting gets a new temporary folder. A cluster session without it is an
    error, because a machine-local folder would lose data.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="tidemark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes a frame as Parquet into the shared folder and gives back its scan, for the time of a block.

    What it wrote is removed at the end of the block, also after a failure; frames over it must not be used any more then.
    """
    folder = scratch_path(spark, "stage")

    def stage(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        remove_folder(spark, folder)


def cut_lineage(df):
    """Materialize ``df`` in the shared folder, so that later stages do not recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

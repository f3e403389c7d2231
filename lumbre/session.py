"""Session settings every operator relies on."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Runtime settings that results depend on (time zone) or that help at scale.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # texts of any length: what a task holds at once stays small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

#: Settings that only a new session can take.
BUILD_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "lumbre", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **BUILD_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session that somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand at most so many rows at once to Python, for what runs inside: rows that are whole blocks are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for what is planned and run inside; ``__`` in a name stands for a dot."""
    wanted = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Shuffled bytes that a task gets within ``fine_parts``, about, and the parts that a shuffle has there at least: with
#: more, Spark's map tasks hold rows to sort them by part.
FINE_BYTES, FINE_PARTS = "8m", 200


@contextmanager
def fine_parts(spark: SparkSession) -> Iterator[None]:
    """Deal the shuffles of what runs inside to more and smaller tasks: for short texts that compress well, but take
    ten times their shuffled bytes and more in a task's hash tables."""
    parts = max(FINE_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fine = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": FINE_BYTES,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
    }
    before = {name: spark.conf.get(name, None) for name in fine}
    for name, value in fine.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Where the session names none, a folder of this machine is taken in local mode only; on a cluster a folder
    on the default filesystem, and an error if that is a local one, as other executors would not see its files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if re.fullmatch(r"local(\[[^-]*\])?", spark.conf.get("spark.master", "local")):
        return os.path.join(tempfile.gettempdir(), "lumbre-shared")
    default = spark.conf.get("spark.hadoop.fs.defaultFS", None) or "file:///"
    if default.startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{default.rstrip('/')}/tmp/lumbre-shared"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage with ``checkpoint()`` in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> str:
    """Send the package to the executors of a session that was not given it with ``--py-files``; returns the archive.

    Operators whose Python runs in tasks need it there, unless it is installed on the workers.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="lumbre-")
    archive = shutil.make_archive(os.path.join(folder, "lumbre"), "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    return archive

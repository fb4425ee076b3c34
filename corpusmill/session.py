"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Bytes of a batch that goes to an Arrow function. A batch of 10,000 long texts with their words is
# many times as large in Python as here, in each worker of an executor.
BATCH_BYTES = 4 << 20


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators rely on.

    A repeated JSON key takes its last value, so the variant parser has to accept it. Batches for
    Arrow functions end after some bytes, so that a worker's memory does not follow the texts.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names for checkpoints.

    Only a local session without that setting falls back to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="corpusmill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table this library wrote itself."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm_path.getFileSystem(conf).delete(jvm_path, True)

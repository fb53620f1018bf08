"""Session defaults and the place for files that runs leave behind."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join stays splittable even when the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Nested repeats of a JSON field keep the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Workers talk over a socket file, not over a loopback port.
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(
    app_name: str, master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory name under the shared folder of the session.

    The cluster names the folder in ``spark.checkpoint.dir``. A local session
    that names none gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="rillworks-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see whole or not at all; one of that name is replaced."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    hidden = jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_{uuid.uuid4().hex}")
    system = where.getFileSystem(conf)
    out = system.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not system.rename(hidden, where):
        system.delete(where, False)
        system.rename(hidden, where)

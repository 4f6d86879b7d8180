"""Session helpers: a tuned local session for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "riskframe") -> SparkSession:
    """A local session with AQE on and the UI off (tests, bench). On a cluster use the cluster's session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RISKFRAME_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Session setting of a narrower folder for intermediate data: of ``scratch``, or one machine's temp folder.
SCRATCH = "riskframe.scratch.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data: ``spark.checkpoint.dir``, else the folder set with
    ``SparkContext.setCheckpointDir``.

    Where neither is set, a local session (``local[*]``: driver and executors share the machine) gets a fresh folder
    under the system's temp dir; on a cluster that is an error, since executors don't see each other's disks."""
    sc = spark.sparkContext
    own = sc.getCheckpointDir()
    conf = spark.conf.get(SCRATCH, None) or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf and own is not None:
        conf = own.rsplit("/", 1)[0]  # Spark keeps a folder of its own below the one that was set
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf = tempfile.mkdtemp(prefix="riskframe-ckpt-")
        spark.conf.set(SCRATCH, conf)
    if own is None:
        sc.setCheckpointDir(conf)
    return conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder for intermediate tables and sinks."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of a query that runs within go at its end, else when the driver happens to collect its garbage."""
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(conf, "false")
    spark.conf.set(conf, "true")
    try:
        yield
    finally:
        spark.conf.set(conf, before)


#: Session setting of the bytes of files that a reading partition gets at most.
READS = "spark.sql.files.maxPartitionBytes"
_own = {"lock": threading.Lock(), "users": 0, "before": ""}


@contextmanager
def own_reads(spark: SparkSession):
    """What runs within may change ``READS``; it is set back when the last thread leaves."""
    with _own["lock"]:
        if not _own["users"]:
            _own["before"] = spark.conf.get(READS)
        _own["users"] += 1
    try:
        yield
    finally:
        with _own["lock"]:
            _own["users"] -= 1
            if not _own["users"]:
                spark.conf.set(READS, _own["before"])


def read_in(df, partitions: int) -> bool:
    """Whether ``df`` has at least so many partitions, if need be after ``READS`` is lowered (to 1 MB at least): rows that come
    straight from files are spread so without a shuffle."""
    spark = df.sparkSession
    parts = lambda: df.select("*").rdd.getNumPartitions()
    if parts() >= partitions:
        return True
    before = spark.conf.get(READS)
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", before.strip().lower()).groups()
    size, least = int(number) << 10 * " kmgtp".index(unit or " "), 1 << 20
    spark.conf.set(READS, str(least))
    if parts() < partitions:
        spark.conf.set(READS, before)
        return False
    while (size := max(least, size // 2)) > least:
        spark.conf.set(READS, str(size))
        if parts() >= partitions:
            return True
    spark.conf.set(READS, str(least))
    return True


#: Bytes of a row group of intermediate tables: a partition that reads them can be as small.
ROW_GROUP = 32 << 20


def materialize(df, name: str, *more):
    """Cut lineage by writing ``df`` as a parquet table under the shared checkpoint folder and reading it back. Tables given as
    ``more`` are written after it, one by one, and are the rest of its rows.

    Same guarantees as a reliable checkpoint (the rows are fixed once written, lost executors cannot change
    them), stored columnar and compressed. Column values — not row order — carry any numbering."""
    path = scratch_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        for part in (df, *more):
            part.write.mode("append").option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def scratch(spark: SparkSession, name: str = "job"):
    """Intermediate tables written within the ``with`` block go below one folder, which is removed at its end. Use it
    round a query and the action that reads its result."""
    before = spark.conf.get(SCRATCH, None)
    path = scratch_path(spark, name)
    spark.conf.set(SCRATCH, path)
    try:
        yield path
    finally:
        if before is None:
            spark.conf.unset(SCRATCH)
        else:
            spark.conf.set(SCRATCH, before)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

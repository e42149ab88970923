"""Intermediate results in the folder that all executors share.

Both forms outlive any executor. The folder is the session's checkpoint directory
(``spark.checkpoint.dir``); only a local session without one gets a temporary folder.
What is written is deleted as soon as nothing reads it any more, where its writer can tell
(``discard``, ``temporary``), else by ``release``.
"""

import contextlib
import tempfile
import uuid

# Spark's own setting: shuffle files go when their query ends, not when the driver next collects its garbage.
DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written = {}  # paths by application
_tables = {}  # names of bucketed tables by application


def shared_folder(spark):
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="basketlens-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpoint(df):
    """Rows in fixed partitions and order, for numbering them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextlib.contextmanager
def shuffles_deleted(spark):
    """The shuffle files of each query that is run inside are deleted when it ends."""
    before = spark.conf.get(DELETE_SHUFFLES, None)
    spark.conf.set(DELETE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DELETE_SHUFFLES)
        else:
            spark.conf.set(DELETE_SHUFFLES, before)


def materialize(df, compact=False):
    """A columnar copy for frames that are read several times: later scans prune columns, and
    the planner knows the true size. For wide copies of the rows ``compact`` saves disk: they take fewer bytes, and the
    shuffle files they were made from go with the write."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    if compact:
        with shuffles_deleted(spark):
            df.write.option("compression", "zstd").parquet(path)
    else:
        df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_path = path
    return table


def materialize_bucketed(df, keys, sort_by=()):
    """A copy in as many buckets of the keys as there are shuffle partitions: joins on the keys don't move it again."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/tables/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, *keys).option("compression", "zstd").option("path", path)
    (writer.sortBy(*sort_by) if sort_by else writer).saveAsTable(name)
    application = spark.sparkContext.applicationId
    _written.setdefault(application, []).append(path)
    _tables.setdefault(application, []).append(name)
    return spark.table(name)


def remember(spark, path):
    """Let ``release`` delete a path that was written by other means."""
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written_bytes(table):
    """Size of the files behind a frame that ``materialize`` returned."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _delete(spark, path):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables):
    """Delete tables that ``materialize`` returned and that no frame reads any more."""
    for table in tables:
        spark = table.sparkSession
        paths = _written.get(spark.sparkContext.applicationId, [])
        if table._written_path in paths:
            paths.remove(table._written_path)
            _delete(spark, table._written_path)


@contextlib.contextmanager
def temporary(spark):
    """Tables that are written inside are deleted at the end, but for those that are passed to the function it gives. The
    shuffle files of what is run inside go with each query."""
    before, kept = set(_written.get(spark.sparkContext.applicationId, [])), set()

    def keep(table):
        kept.add(table._written_path)
        return table

    try:
        with shuffles_deleted(spark):
            yield keep
    finally:
        paths = _written.get(spark.sparkContext.applicationId, [])
        for path in [p for p in paths if p not in before and p not in kept]:
            paths.remove(path)
            _delete(spark, path)


def release(spark):
    """Delete the tables this session has written, once results that read them are written themselves."""
    context = spark.sparkContext
    for name in _tables.pop(context.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for path in _written.pop(context.applicationId, []):
        _delete(spark, path)


def spread(scan):
    """Spread a scan that has fewer splits than the cluster has cores; larger scans are left alone."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan

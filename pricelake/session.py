"""Session construction and shared-storage scratch paths."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the analytics rely on. Shuffle parallelism stays configurable: AQE
# coalesces small partitions and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    # HotSpot does not JIT-compile methods over 8000 bytecode bytes; a fused
    # stage above that runs interpreted and is slower than no fusion at all.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def scale_conf(input_bytes: int, shuffled_bytes: int | None = None, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a run that reads ``input_bytes`` and shuffles ``shuffled_bytes`` at most in one stage.

    Scan splits of ``target_partition_bytes``; the initial shuffle width is the
    shuffled size over the same target (at least Spark's 200), so no reducer
    starts with more than a few hundred MB even before AQE coalesces small
    partitions and splits skewed ones (a partition over 4x the median and
    512 MB is split). The cleaning and landing writes shuffle their whole
    input (100 TB: about 400k partitions); the market questions shuffle
    pre-aggregated rows only, so their width stays moderate.

    AQE may turn a join into a broadcast when the *measured* size of one side
    is at most 64 MB (for example the one-row-per-(commodity, day) table joined
    back in the national average); larger sides keep the shuffle join with
    skew splitting. Static planning keeps Spark's 10 MB estimate threshold.
    """
    shuffled = input_bytes if shuffled_bytes is None else shuffled_bytes
    partitions = max(200, -(-shuffled // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(
    master: str | None = None,
    app_name: str = "pricelake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, which every session must set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return root.rstrip("/")


def application_scratch(spark: SparkSession) -> str:
    """This application's part of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/pricelake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path in this application's part of the shared checkpoint folder."""
    return f"{application_scratch(spark)}/{name}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


def written(spark: SparkSession, df: DataFrame, name: str, keep: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it back.

    Cuts the lineage at a table every executor can reach, so a lost executor
    costs a re-read and not a recomputation. The table belongs to the innermost
    :func:`scratch_scope`, with ``keep`` to the one around it.
    """
    path = scratch_path(spark, name)
    owners = _scopes[:-1] if keep else _scopes
    if owners:
        owners[-1].append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession, drop: bool = True) -> Iterator[list[str]]:
    """The paths that :func:`written` makes inside; with ``drop`` they are deleted at the end.

    What leaves such a scope must not read its tables any more: it is itself written with ``keep``.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.pop()
    if drop:
        drop_paths(spark, paths)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of each action are deleted at its end; otherwise they stay until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    paths.clear()


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application left under :func:`scratch_path`; call it when no result of the session is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(application_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

"""Intermediate tables in a folder that all executors share.

A written table cuts the lineage, survives the loss of executors and lets the
optimizer see real sizes. The folder is the session's ``spark.checkpoint.dir``
or, where that is unset, a folder below the session's warehouse; a local
warehouse is refused on a cluster.

Tables written inside ``scratch_scope`` are removed when it ends. Others back a
result that has not been read yet; ``clear_scratch`` removes them with all
else the application has left.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCOPE = "tallycart.scratch.scope"


def scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        if root.startswith(("file:", "/")) and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse lies on one machine")
    return f"{root.rstrip('/')}/tallycart/{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    scope = spark.sparkContext.getLocalProperty(_SCOPE)
    inner = f"{scope}/" if scope else ""
    return f"{scratch_root(spark)}/{inner}{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it is on."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Tables written inside, also by threads that inherit the session's properties, go when it ends."""
    context, scope = spark.sparkContext, f"scope-{uuid.uuid4().hex}"
    outer = context.getLocalProperty(_SCOPE)
    context.setLocalProperty(_SCOPE, f"{outer}/{scope}" if outer else scope)
    folder = f"{scratch_root(spark)}/{context.getLocalProperty(_SCOPE)}"
    try:
        yield folder
    finally:
        context.setLocalProperty(_SCOPE, outer)
        _forget(spark, folder)
        remove(spark, folder)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all tables of this application; results not yet read are lost."""
    _forget(spark, scratch_root(spark))
    remove(spark, scratch_root(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and hand back a reader over the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bucketed tables by name, with the folder each lies in; the catalog knows them while they are in use.
_bucketed: dict[str, str] = {}


def _forget(spark: SparkSession, folder: str) -> None:
    for name in [n for n, path in _bucketed.items() if path.startswith(f"{folder}/")]:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        _bucketed.pop(name, None)


def materialize_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """Write ``df`` once in buckets of ``key`` and hand back a reader that knows them.

    Grouping by ``key``, alone or with other columns, then needs no exchange. As many buckets are
    made as the session has shuffle partitions, the figure that follows the size of its data.
    """
    spark = df.sparkSession
    path, buckets = scratch_path(spark, label), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    _bucketed[name] = path
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)

"""Storage layouts: stages bucketed by the row key, and tables clustered by it for point look-ups.

Two stages that are bucketed alike by the row key join without a shuffle: the rows of a key are in the same bucket file of
both, sorted. A table that is range-clustered by the key, with Parquet bloom filters on it, answers a look-up of a few keys
from the few row groups that can hold them.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.session import scratch_dir
from riskflow.settings import DEFAULT


def store_bucketed(df: DataFrame, key: str = DEFAULT.id_col, buckets: int | None = None, name: str = "stage") -> DataFrame:
    """``df`` as a table in the shared folder with one sorted file per bucket of ``key``.

    Tables meant to be joined take the same number of ``buckets`` (default: the session's shuffle partitions). The catalog entry
    has a name of its own; ``drop_bucketed`` removes it and its files.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"riskflow_{name}_{uuid.uuid4().hex}"
    path = os.path.join(scratch_dir(spark), table)
    # dealt by the same hash as the buckets are, so that each task writes whole buckets
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return spark.table(table)


def drop_bucketed(df: DataFrame) -> None:
    """Remove a table of ``store_bucketed`` from the catalog, and its files."""
    spark = df.sparkSession
    paths = {os.path.dirname(f) for f in df.inputFiles()}
    for t in spark.catalog.listTables():
        if t.name.startswith("riskflow_") and any(p.endswith("/" + t.name) for p in paths):
            spark.sql(f"DROP TABLE {t.name}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def sink_clustered(df: DataFrame, path: str, key: str = DEFAULT.id_col, rows_per_file: int = 1_000_000,
                   rows_per_group: int = 100_000) -> DataFrame:
    """Write ``df`` in ranges of ``key``, sorted, with a bloom filter on the key in every row group; returns the table read back.

    Column minima and maxima tell which row groups can hold a key of the range; the bloom filters also keep out absent ones.
    """
    n = df.count()
    files = max(1, -(-n // rows_per_file))
    (df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", str(max(1, min(n, rows_per_group))))
     .option("parquet.block.row.count.limit", str(rows_per_group)).parquet(path))
    return df.sparkSession.read.parquet(path)


def lookup(df: DataFrame, ids: list, key: str = DEFAULT.id_col) -> DataFrame:
    """The rows of ``df`` with one of ``ids`` (a short list of the caller's): a filter that reaches a file scan."""
    ids = sorted({i for i in ids if i is not None})
    if not ids:
        return df.where(F.lit(False))
    # up to ten equalities reach the bloom filters, beyond that Spark pushes the range of the list and filters after
    step = 10
    found = F.lit(False)
    for i in range(0, len(ids), step):
        found = found | F.col(key).isin(ids[i: i + step])
    return df.where(found)

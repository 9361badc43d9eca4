"""S3 log routing sink and S5 durable append with tail.

S3 writes each record under its namespace directory (``partitionBy``), with
the log group and stream names a log shipper would use, so a reader of one
group prunes every other directory.  One rebalancing shuffle sizes the files: a
namespace with a third of all records is split over many tasks, small ones are
not scattered into many small files.

S5 appends to durable storage and reads back the last ``n`` records by an
ordinal column: ``orderBy(desc).limit(n)`` plans as TakeOrderedAndProject, a
per-partition top-n and a merge of n rows per partition, never a full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Log group template and stream prefix of the log shipper.
LOG_GROUP_TEMPLATE = "/aws/eks/{cluster}/"
LOG_STREAM_PREFIX = "fb-"


def log_route(df: DataFrame, cluster: str, namespace: str = "namespace_name") -> DataFrame:
    """Adds ``log_group`` = /aws/eks/<cluster>/<namespace> and ``log_stream``
    = fb-<namespace>."""
    ns = F.col(namespace)
    return df.withColumns({
        "log_group": F.concat(F.lit(LOG_GROUP_TEMPLATE.format(cluster=cluster)), ns),
        "log_stream": F.concat(F.lit(LOG_STREAM_PREFIX), ns),
    })


def write_routed(df: DataFrame, path: str, cluster: str, namespace: str = "namespace_name",
                 mode: str = "append") -> None:
    """Batch sink of routed records, one directory per namespace.  The
    ``rebalance`` hint lets AQE size the output files: small namespaces are
    coalesced, a namespace holding a third of all records is split over many
    tasks instead of one."""
    (log_route(df, cluster, namespace).hint("rebalance", namespace)
     .write.mode(mode).partitionBy(namespace).parquet(path))


def read_group(spark: SparkSession, path: str, namespace: str | None = None,
               ns_col: str = "namespace_name") -> DataFrame:
    """Read routed records back; a namespace filter prunes directories."""
    df = spark.read.parquet(path)
    return df.where(F.col(ns_col) == namespace) if namespace is not None else df


def append_lines(df: DataFrame, path: str) -> None:
    """Durable append (each call adds files, never rewrites old ones)."""
    df.write.mode("append").parquet(path)


def tail(spark: SparkSession, path: str, n: int, order: str = "seq") -> DataFrame:
    """The last ``n`` records by ``order`` (``tail -n``), read by another session."""
    return spark.read.parquet(path).orderBy(F.col(order).desc()).limit(n)


def append_and_tail(df: DataFrame, path: str, n: int, order: str = "seq") -> DataFrame:
    append_lines(df, path)
    return tail(df.sparkSession, path, n, order)


def route_stream(stream: DataFrame, path: str, checkpoint: str, cluster: str,
                 namespace: str = "namespace_name", trigger: dict | None = None):
    """S3 as a continuous sink: routed records appended per micro-batch under
    namespace directories; the checkpoint makes each batch land exactly once
    in the file sink."""
    w = (log_route(stream, cluster, namespace).writeStream.format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint).partitionBy(namespace)
         .outputMode("append"))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()

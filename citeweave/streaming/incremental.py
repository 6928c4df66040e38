"""Links that take in new references as they arrive, by the key ranges that these touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeweave.operators.extract import extract_edges
from citeweave.operators.invert import dedup_links
from citeweave.schemas import LINKS, REFS
from citeweave.storage import exists, remove
from citeweave.streaming.commits import key_range


def read_links(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{LINKS}, key_range int").parquet(path)


def merge_links(edges: DataFrame, path: str, ranges: int = 64) -> None:
    """Adds edges to stored links: of each pair the first in input order stays, whenever it came.

    Only touched ranges are written, beside the table first, then in their places; a merge that ends in between can be
    done again, as taking the same edges in twice changes nothing.
    """
    spark = edges.sparkSession
    new = dedup_links(edges).withColumn("key_range", key_range(F.col("cited_id"), ranges))
    beside = f"{path.rstrip('/')}_merged"
    # What lies beside is not dealt out by range: only the last write is.
    new.write.mode("overwrite").option("compression", "zstd").parquet(f"{beside}/new")
    new = read_links(spark, f"{beside}/new")
    touched = [r[0] for r in new.select("key_range").distinct().collect()]  # at most as many numbers as there are ranges
    if not touched:
        return
    whole = new
    if exists(spark, path):
        both = new.unionByName(read_links(spark, path).where(F.col("key_range").isin(touched)))
        dedup_links(both).withColumn("key_range", key_range(F.col("cited_id"), ranges)).write.mode("overwrite").option("compression", "zstd").parquet(f"{beside}/whole")
        whole = read_links(spark, f"{beside}/whole")
    dealt = whole.hint("rebalance", F.col("key_range"))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("key_range").option("compression", "zstd").parquet(path)
    remove(spark, beside)


def stream_links(spark: SparkSession, source: str, path: str, checkpoint: str, mode: str = "doi", ranges: int = 64) -> StreamingQuery:
    """Takes Parquet files of references in as they arrive; each file once, by the checkpoint."""
    refs = spark.readStream.schema(REFS).parquet(source)
    merge = lambda batch, _: merge_links(extract_edges(batch, mode), path, ranges)
    return refs.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

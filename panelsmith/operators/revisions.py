"""Latest revisions as stored state: a new vintage touches what it revises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.operators.placement import latest_per_key
from panelsmith.session import cut_lineage

#: Distinct partitions of a vintage up to which the state is pruned by a list of
#: them; more are pruned by a semi join.
LIST_PARTITIONS = 10_000


def apply_vintage(state: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str], partition: str) -> None:
    """Merge ``batch`` into the table at ``state`` (Parquet, laid out by
    ``partition``, which must follow from the keys): per key the row with the
    greatest ``order`` stays. Only partitions that the batch holds rows of are
    read and, as a dynamic overwrite, replaced; the others keep their files.
    Applying a batch again changes nothing. The first batch makes the table."""
    spark = batch.sparkSession
    batch = cut_lineage(batch, "vintage")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
    exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    rows = batch
    if exists:
        current = spark.read.schema(batch.schema).parquet(state).select(*batch.columns)
        touched = batch.select(partition).distinct()
        listed = [r[0] for r in touched.limit(LIST_PARTITIONS + 1).collect()]
        if len(listed) <= LIST_PARTITIONS:
            current = current.where(F.col(partition).isin(listed))  # prunes folders
        else:
            current = current.join(touched, partition, "left_semi")
        rows = current.unionByName(batch)
    # written before the files that it is read from are replaced
    merged = cut_lineage(latest_per_key(rows, [partition, *keys], order).select(*batch.columns), "revised")
    merged.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(state)

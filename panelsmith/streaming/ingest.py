"""Incremental ingestion of landed source files with Structured Streaming.

The batch normalisers read every landed page at once. When pages keep
arriving (a new month of a series, a new revision), the same normalising
transform can run as a streaming query over the landing folder: each trigger
picks up only the new files, and the file sink plus the checkpoint give
exactly-once output that survives restarts and lost executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from panelsmith.session import shared_dir


def stream_landing(
    spark: SparkSession,
    source_dir: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    sink_dir: str,
    name: str,
    fmt: str = "json",
    options: dict | None = None,
    partition_by: Sequence[str] = (),
    checkpoint_dir: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start a query landing-folder -> ``transform`` -> Parquet sink.

    ``transform`` must be stateless (projections, explodes, casts, filters,
    joins with static dimensions), e.g. the record-level part of a source
    normaliser. With ``available_now`` the query processes what is there and
    stops; otherwise it keeps running on the default trigger.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    opts = {"multiLine": "true"} if fmt == "json" else {"header": "true"}
    opts.update(options or {})
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    for k, v in opts.items():
        reader = reader.option(k, v)
    out = transform(reader.load(source_dir))
    ckpt = checkpoint_dir or shared_dir(spark, "streams", name)
    writer = out.writeStream.format("parquet").option("checkpointLocation", ckpt).queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(sink_dir)

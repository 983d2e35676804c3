"""Readers and writers for landed files (CSV, gzip CSV, JSON pages, Parquet).

Schemas are explicit, or inferred over all rows by ``infer_csv_schema``; malformed
input fails the job (FAILFAST) instead of silently becoming NULL. Writers are
distributed DataFrame writes; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from panelsmith.functions.columns import nan_to_null


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str, header: bool = True, **options) -> DataFrame:
    """CSV (plain or .gz, decompressed transparently) with a fixed schema.
    Plain CSV is split across tasks; a gzip file is read by one task, so land
    large gzip sources as many files (or convert them once with
    ``streaming.ingest.stream_landing``)."""
    r = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path if isinstance(path, str) else list(path))


#: Types in the order they are tried: what a value must look like, and be cast to.
INFERRED = (
    ("boolean", "(?i)^(true|false)$"),
    ("bigint", "^-?(0|[1-9][0-9]*)$"),
    ("double", r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"),
    ("date", "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp", "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}"),
)


def infer_csv_schema(spark: SparkSession, path: str | Sequence[str], **options) -> str:
    """The schema of a CSV with a header, as DDL, from all rows in one
    aggregate: per column the first of INFERRED that every value fits, else
    string. Numbers with leading zeros are codes and stay strings; empty values
    are null and fit all; a column without values is a string. The driver gets
    one row of booleans, whatever the number of rows."""
    raw = spark.read.options(header=True, inferSchema=False, mode="FAILFAST", **options).csv(path)

    def quoted(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"

    def fits(c: str, kind: str, form: str):
        value = F.col(quoted(c))
        return F.bool_and(F.when(value.isNotNull(), value.rlike(form) & value.try_cast(kind).isNotNull()))

    names = list(enumerate(raw.columns))
    row = raw.agg(*[fits(c, kind, form).alias(f"{i}_{kind}") for i, c in names for kind, form in INFERRED]).first()
    found = [next((kind for kind, _ in INFERRED if row[f"{i}_{kind}"]), "string") for i, _ in names]
    return ", ".join(f"{quoted(c)} {kind}" for (_, c), kind in zip(names, found))


def read_inferred_csv(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    """``read_csv`` with the schema that ``infer_csv_schema`` finds; two scans."""
    return read_csv(spark, path, infer_csv_schema(spark, path, **options), **options)


def read_parquet(spark: SparkSession, path: str | Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else list(path)))
    return nan_to_null(df.select(*cols) if cols else df)


def read_json_pages(
    spark: SparkSession, path: str | Sequence[str], schema: str, multi_line: bool = True
) -> DataFrame:
    """JSON pages parsed with ``schema``; all pages of one source are read by
    a single scan, replacing a driver loop that fetched and concatenated them.

    ``multi_line=True``: one JSON document per file (an API page). Such a file
    cannot be split, so each page is one task; land pages of bounded size.
    ``multi_line=False``: JSON Lines, one document per line, split across tasks
    like CSV, for sources too large for single-task files."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def explode_records(df: DataFrame, array_path: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the array at ``array_path`` (struct fields
    become columns), carrying the ``keep`` columns along."""
    return df.select(*keep, F.inline(F.col(array_path)))


def inline_json_records(
    df: DataFrame, col: str, element_schema: str, keep: Sequence[str] = (), wrap_object: bool = False
) -> DataFrame:
    """Parse a JSON text column holding an array of records (or one record
    when ``wrap_object``) and expand it to rows with typed columns.

    A malformed payload fails the job. A NULL payload, and an empty array,
    keeps one row whose record columns are NULL."""
    text = F.concat(F.lit("["), F.col(col), F.lit("]")) if wrap_object else F.col(col)
    records = ArrayType(StructType.fromDDL(element_schema))
    parsed = F.from_json(text, records, {"mode": "FAILFAST"})
    return df.select(*keep, parsed.alias("__recs")).select(*keep, F.inline_outer("__recs"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, one file per partition, no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)

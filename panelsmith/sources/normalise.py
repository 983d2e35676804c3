"""Per-source normalisers: landed payloads -> (group, period, value) tables.

Each source is read by one Spark scan over all of its landed files (pages of
several series or countries side by side), with an explicit schema, and
shaped by DataFrame operators. Landing layouts:

``rates_panel``   <root>/series_id=<ID>/*.json   {"observations": [{date, realtime_start, value}]}
``price_panel``   <root>/series=<column>/*.json  {"response": {"data": [{period, value}]}}
``reserves``      <root>/*.json                  {"value": [{OBS_VALUE, REF_AREA, TIME_PERIOD, UNIT_MEASURE}]}
``event_counts``  CSV export of the sheet        Country, Month (name), Year, Events
``wide_index``    CSV export of the sheet        month (date), GPRC_<ISO3> ..., other columns
``period_index``  flat CSV                       TIME_PERIOD ('2006-M04'), COUNTRY (ISO3), value
``shipping_index`` gzip CSV                      Economy_Label, Month_Label ('feb. 2006'), <value column>
``quarterly_patch`` CSV                          date ('Mar 2006'), cpi_index
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelsmith.functions.columns import invert_when, lenient_cast, norm_columns, norm_string, strict_cast
from panelsmith.functions.dates import month_from_name, month_label_parts, period_from_label, quarter_month
from panelsmith.operators.joins import outer_join_complete, semi_join
from panelsmith.operators.placement import latest_per_key
from panelsmith.operators.reshape import melt
from panelsmith.sources import dims
from panelsmith.sources.landed import explode_records, read_csv, read_json_pages


def _date_floor(df: DataFrame, col: str, start: str | None) -> DataFrame:
    return df if start is None else df.where(F.col(col) >= F.to_date(F.lit(start)))


def rates_panel(
    spark: SparkSession, root: str, catalog: DataFrame | None = None, start: str | None = "2006-01-01", multi_line: bool = True
) -> DataFrame:
    """(date, country, interest_rate, fx_rate): monthly rate and daily FX per
    country, joined on (country, yyyymm), rows with a gap dropped.

    Per (series, date) the latest revision (max realtime_start) wins, of equal
    ones the first in the page; its value is cast leniently ('.' -> NULL) and does not fall back to an
    earlier revision. FX quotes flagged ``invert`` in the catalog become 1/x.
    """
    schema = (
        "observations array<struct<date:string, realtime_start:string, value:string>>, series_id string"
    )
    pages = read_json_pages(spark, root, schema, multi_line)
    obs = pages.select("series_id", F.posexplode("observations").alias("pos", "o")).select(
        "series_id",
        F.to_date("o.date").alias("date"),
        F.to_date("o.realtime_start").alias("realtime_start"),
        F.col("o.value").alias("value"),
        (-F.col("pos")).alias("from_end"),
    )
    latest = latest_per_key(obs, ["series_id", "date"], ["realtime_start"], tiebreak=["from_end"]).drop("from_end")
    latest = _date_floor(latest.withColumn("value", lenient_cast("value", "double")), "date", start)
    # the built-in catalog has 32 rows and is broadcast; a caller's catalog has
    # no known bound, so AQE decides from its measured size
    cat = F.broadcast(dims.series_catalog(spark)) if catalog is None else catalog
    tagged = latest.join(cat, "series_id").withColumns(
        {"value": invert_when("value", F.col("invert")), "yyyymm": F.date_format("date", "yyyyMM")}
    )
    fx = tagged.where(F.col("kind") == "fx_rate").select("country", "yyyymm", "date", F.col("value").alias("fx_rate"))
    rate = tagged.where(F.col("kind") == "interest_rate").select(
        "country", "yyyymm", F.col("value").alias("interest_rate")
    )
    return outer_join_complete(fx, rate, ["country", "yyyymm"]).select("date", "country", "interest_rate", "fx_rate")


def price_panel(spark: SparkSession, root: str, multi_line: bool = True) -> DataFrame:
    """(date, <series columns>...): daily series, dates that all of them have;
    all pages (date batches) of a series are read by one scan. Pages may
    overlap (see ``coverage.page_coverage``) where their values agree; a date
    with two values fails the job."""
    schema = "response struct<data: array<struct<period:string, value:string>>>, series string"
    pages = read_json_pages(spark, root, schema, multi_line)
    rows = explode_records(pages, "response.data", keep=["series"]).select(
        "series", F.to_date("period", "yyyy-MM-dd").alias("date"), strict_cast("value", "double").alias("value")
    )
    names = [name for name, _ in dims.OIL_SERIES]
    own = [F.when(F.col("series") == n, F.col("value")) for n in names]
    wide = rows.groupBy("date").agg(*[F.min(v).alias(n) for n, v in zip(names, own)], *[F.max(v).alias(f"max_{n}") for n, v in zip(names, own)])
    twice = F.raise_error(F.concat(F.lit("pages with different values for "), F.col("date").cast("string")))
    one = [F.when(F.col(n) == F.col(f"max_{n}"), F.col(n)).otherwise(twice).alias(n) for n in names]
    return wide.where(F.col("date").isNotNull()).dropna(subset=names).select("date", *one)


def reserves(spark: SparkSession, root: str, unit: str = "USD", multi_line: bool = True) -> DataFrame:
    """(country, year, month, fx_reserves) from reserve pages, one unit only."""
    schema = (
        "value array<struct<OBS_VALUE:string, REF_AREA:string, TIME_PERIOD:string, UNIT_MEASURE:string>>"
    )
    pages = read_json_pages(spark, root, schema, multi_line)
    rows = norm_columns(explode_records(pages, "value"))
    rows = rows.where(F.col("unit_measure") == unit)
    year, month = period_from_label("time_period")
    rows = rows.select(
        "ref_area", year.alias("year"), month.alias("month"), strict_cast("obs_value", "double").alias("fx_reserves")
    )
    return dims.map_iso3(rows, "ref_area").select("country", "year", "month", "fx_reserves")


def event_counts(spark: SparkSession, path: str, start_year: int = 2006) -> DataFrame:
    """(country, month, year, events): names normalised and matched through
    the alias dimension (exact match), years from ``start_year``, month
    names mapped to numbers (an unknown name fails the job)."""
    raw = norm_columns(read_csv(spark, path, "Country string, Month string, Year int, Events int"))
    named = raw.withColumn("alias", norm_string("country")).drop("country")
    kept = dims.map_alias(named, "alias").where(F.col("country").isNotNull())
    kept = kept.where(F.col("year") >= start_year)
    return kept.select("country", month_from_name("month").alias("month"), "year", "events")


def wide_index(
    spark: SparkSession, path: str, schema: str, prefix: str = "gprc_", start: str = "2006-01-01"
) -> DataFrame:
    """(country, year, month, gpr_index) from a wide sheet with one column per
    country code; NULL cells are kept by the melt."""
    raw = norm_columns(read_csv(spark, path, schema))
    raw = raw.where(F.col("month") >= F.to_date(F.lit(start)))
    codes = [c for c in raw.columns if c.startswith(prefix)]
    long = melt(raw, ["month"], codes, "series", "gpr_index")
    long = long.withColumn("iso3", F.upper(F.get(F.split("series", "_"), 1)))
    long = dims.map_iso3(long, "iso3").where(F.col("country").isNotNull())
    return long.select("country", F.year("month").alias("year"), F.month("month").alias("month"), "gpr_index")


def open_wide_index(spark: SparkSession, path: str, prefix: str = "gprc_", start: str = "2006-01-01") -> DataFrame:
    """(country, year, month, gpr_index) from wide JSON records whose country
    columns are not known beforehand: each record is read as one VARIANT and
    its fields become rows, so that a new country needs no schema. A null
    cell stays a row; a cell that is no number fails the job."""
    raw = spark.read.format("json").option("singleVariantColumn", "sheet").option("mode", "FAILFAST").load(path)
    cells = spark.sql(
        "SELECT variant_get(sheet, '$.month', 'date') AS month, lower(e.key) AS series, CAST(e.value AS double) AS gpr_index "
        "FROM {raw}, LATERAL variant_explode(sheet) AS e WHERE startswith(lower(e.key), {prefix})",
        raw=raw.where(F.expr("variant_get(sheet, '$.month', 'date')") >= F.to_date(F.lit(start))),
        prefix=prefix,
    )
    cells = cells.withColumn("iso3", F.upper(F.get(F.split("series", "_"), 1)))
    cells = dims.map_iso3(cells, "iso3").where(F.col("country").isNotNull())
    return cells.select("country", F.year("month").alias("year"), F.month("month").alias("month"), "gpr_index")


def _period_values(rows: DataFrame) -> DataFrame:
    """(country, value, year, month) of rows (time_period, country as ISO-3, value)."""
    year, month = period_from_label("time_period")
    rows = rows.select(F.col("country").alias("iso3"), "value", year.alias("year"), month.alias("month"))
    return dims.map_iso3(rows, "iso3").select("country", "value", "year", "month")


def period_index(spark: SparkSession, path: str) -> DataFrame:
    """(country, value, year, month) from a flat SDMX-style export."""
    return _period_values(norm_columns(read_csv(spark, path, "TIME_PERIOD string, COUNTRY string, value double")))


def period_message(spark: SparkSession, path: str) -> DataFrame:
    """(country, value, year, month) from SDMX messages in XML: Series elements
    with the country as attribute and nested Obs elements (TIME_PERIOD,
    OBS_VALUE). Splittable by series; a malformed one fails the job."""
    schema = "_COUNTRY string, Obs array<struct<_TIME_PERIOD:string,_OBS_VALUE:double>>"
    series = spark.read.format("xml").schema(schema).option("rowTag", "Series").option("mode", "FAILFAST").load(path)
    obs = series.select(F.col("_COUNTRY").alias("country"), F.inline("Obs"))
    return _period_values(obs.select("country", F.col("_TIME_PERIOD").alias("time_period"), F.col("_OBS_VALUE").alias("value")))


def shipping_index(spark: SparkSession, path: str, value_col: str = "Index_Average_M2_2023__100_Value") -> DataFrame:
    """(country, year, month, lsci) from a (gzip) CSV with month labels such
    as 'feb. 2006' or 'may 2006'; economy names matched by alias equality."""
    schema = f"Economy_Label string, Month_Label string, {value_col} double"
    raw = norm_columns(read_csv(spark, path, schema))
    month, year = month_label_parts("month_label")
    rows = raw.select(
        norm_string("economy_label").alias("alias"),
        year.alias("year"),
        month.alias("month"),
        F.col(value_col.lower()).alias("lsci"),
    )
    return dims.map_alias(rows, "alias").where(F.col("country").isNotNull()).select("country", "year", "month", "lsci")


def quarterly_patch(spark: SparkSession, path: str, group: str) -> DataFrame:
    """(country, year, month, patch value) from 'Mmm yyyy' quarterly labels."""
    raw = read_csv(spark, path, "date string, cpi_index double")
    return raw.select(
        F.lit(group).alias("country"),
        F.substring("date", 5, 4).cast("int").alias("year"),
        quarter_month(F.substring("date", 1, 3)).alias("month"),
        F.col("cpi_index").alias("patch_cpi"),
    )


def keep_groups(df: DataFrame, group_col: str = "country") -> DataFrame:
    """Rows whose group is one of the panel groups (semi join, no fan-out)."""
    members = F.broadcast(dims.countries(df.sparkSession).select(F.col("country").alias(group_col)))
    return semi_join(df, members, [group_col])

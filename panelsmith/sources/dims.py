"""Fixed dimensions: the group list, source aliases and series catalogs.

These tables have a size bound by construction (16 groups, 32 series), so
joins against them use an explicit broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The 16 groups (snake_case country key) and their ISO-3 codes.
COUNTRIES = [
    ("australia", "AUS"),
    ("brazil", "BRA"),
    ("canada", "CAN"),
    ("china", "CHN"),
    ("france", "FRA"),
    ("germany", "DEU"),
    ("india", "IND"),
    ("italy", "ITA"),
    ("japan", "JPN"),
    ("mexico", "MEX"),
    ("south_korea", "KOR"),
    ("russia", "RUS"),
    ("south_africa", "ZAF"),
    ("turkiye", "TUR"),
    ("united_kingdom", "GBR"),
    ("united_states", "USA"),
]

# Source spellings that map onto a group key (alias -> key). Fixed values:
# the first two are the reference's remaps; the others are added here so that
# exact-name matching does not drop those groups.
ALIASES = [
    ("russian_federation", "russia"),
    ("republic_of_korea", "south_korea"),
    ("korea,_republic_of", "south_korea"),
    ("turkey", "turkiye"),
    ("united_states_of_america", "united_states"),
]

# Per group, the monthly interest-rate series and the FX series.
SERIES = [
    ("australia", "IRSTCI01AUM156N", "DEXUSAL"),
    ("brazil", "IRSTCI01BRM156N", "DEXBZUS"),
    ("canada", "IRSTCI01CAM156N", "DEXCAUS"),
    ("china", "IRSTCI01CNM156N", "DEXCHUS"),
    ("france", "IRSTCI01FRM156N", "DEXSZUS"),
    ("germany", "IRSTCI01DEM156N", "CCUSSP01DEM650N"),
    ("india", "IRSTCI01INM156N", "DEXINUS"),
    ("italy", "IRSTCI01ITM156N", "CCUSSP01ITM650N"),
    ("japan", "IRSTCI01JPM156N", "DEXJPUS"),
    ("mexico", "IRSTCI01MXM156N", "DEXMXUS"),
    ("south_korea", "IRSTCI01KRM156N", "DEXKOUS"),
    ("russia", "IRSTCI01RUM156N", "CCUSSP02RUM650N"),
    ("south_africa", "IRSTCI01ZAM156N", "DEXSFUS"),
    ("turkiye", "IRSTCI01TRM156N", "CCUSSP01TRM650N"),
    ("united_kingdom", "IRSTCI01GBM156N", "DEXUSUK"),
    ("united_states", "IRSTCI01USM156N", "DTWEXBGS"),
]

# Daily oil price series (column name -> series id).
OIL_SERIES = [("brent_dollars_per_barrel", "RBRTE"), ("wti_dollars_per_barrel", "RWTC")]

# Groups whose FX series is monthly (one panel row per month).
MONTHLY_FX_GROUPS = ("germany", "italy", "russia", "turkiye")


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRIES, "country string, iso3 string")


def aliases(spark: SparkSession) -> DataFrame:
    """alias -> group, including every group key mapping to itself."""
    rows = ALIASES + [(c, c) for c, _ in COUNTRIES]
    return spark.createDataFrame(rows, "alias string, country string")


def series_catalog(spark: SparkSession) -> DataFrame:
    """(country, kind, series_id, invert). ``invert`` marks quotes of national
    currency per USD ('..US' ids, tested from the 6th character), which the
    panel turns into USD per unit; it is a column, not a rule in code."""
    rows = []
    for country, rate_id, fx_id in SERIES:
        rows.append((country, "interest_rate", rate_id, False))
        rows.append((country, "fx_rate", fx_id, fx_id[5:] == "US"))
    return spark.createDataFrame(rows, "country string, kind string, series_id string, invert boolean")


def map_iso3(df: DataFrame, code_col: str, out: str = "country") -> DataFrame:
    """Left join on the ISO-3 dimension; unknown codes keep a NULL group."""
    dim = F.broadcast(countries(df.sparkSession).withColumnRenamed("iso3", code_col).withColumnRenamed("country", out))
    return df.join(dim, code_col, "left")


def map_alias(df: DataFrame, name_col: str, out: str = "country") -> DataFrame:
    """Left join on the alias dimension by exact (normalised) name."""
    dim = F.broadcast(aliases(df.sparkSession).withColumnRenamed("alias", name_col).withColumnRenamed("country", out))
    return df.join(dim, name_col, "left")


def unmatched(df: DataFrame, source_col: str, group_col: str = "country") -> DataFrame:
    """Source names that mapped to no group (reported, never silently dropped)."""
    return df.where(F.col(group_col).isNull()).select(source_col).distinct()

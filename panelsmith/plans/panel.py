"""Panel assembly: sources joined onto a daily group x date base, filled,
overridden and cut, as one lazy Spark plan.

Order of steps (each a DataFrame operator from ``panelsmith.operators``):

1. base (group, date, rates...) LEFT JOIN daily prices on date
2. forward fill the prices per group by date (market holidays)
3. add year, month; LEFT JOIN monthly event counts on (year, month, group);
   missing counts -> 0
4. keep each month's count on the last observed day of the month, 0 elsewhere
5. LEFT JOIN the monthly index on (year, month, group); LEFT JOIN the patch
   series; override chain (a fixed value for one group and some months beats
   a present value; else a missing value takes the patch); forward fill by
   (year, month)
6. LEFT JOIN a second monthly index (gpr)
7. remap the first period of the third index (lsci) so the fill can start,
   LEFT JOIN it, forward fill by (year, month)
8. cutoff: keep rows with date > cutoff (after the fills, so earlier values
   still seed them)
9. LEFT JOIN the target (reserves) on (year, month, group)

All right sides are period tables; AQE chooses broadcast or shuffle from
their measured sizes. The fills use the bucketed strategy (per group and
year), so no single task holds a whole group's history.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelsmith.functions.columns import override_chain, zero_fill
from panelsmith.operators.fill import forward_fill
from panelsmith.operators.joins import left_join, merge_periods
from panelsmith.operators.placement import period_end_place


@dataclass
class PanelSpec:
    """Column names and rules of the panel. The defaults are the
    reference's rules (override 84.5 for australia in 2006 months 3-5; first
    lsci period 2006-02 moved to month 3 for germany, italy, russia, turkiye
    and to month 4 for the others; rows kept after 2006-04-30)."""

    group: str = "country"
    date: str = "date"  # DateType
    price_cols: list = field(default_factory=lambda: ["brent_dollars_per_barrel", "wti_dollars_per_barrel"])
    events_col: str = "events"
    index_col: str = "cpi"
    patch_col: str = "patch_cpi"
    gpr_col: str = "gpr_index"
    lsci_col: str = "lsci"
    target_col: str = "fx_reserves"
    override_group: object = "australia"
    override_year: int = 2006
    override_months: tuple = (3, 4, 5)
    override_value: float = 84.5
    lsci_first_year: int = 2006
    lsci_first_month: int = 2
    lsci_monthly_groups: tuple = ("germany", "italy", "russia", "turkiye")
    lsci_monthly_to: int = 3
    lsci_others_to: int = 4
    cutoff: str = "2006-04-30"
    # add ``events_covered``: the row's month lies inside the event source's
    # own coverage for the group (zero-filled months outside it are not
    # observed zeros)
    flag_event_coverage: bool = False


def remap_first_period(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Move the first observed period of the lsci series onto the month the
    panel starts with, per group class."""
    first = (F.col("year") == spec.lsci_first_year) & (F.col("month") == spec.lsci_first_month)
    return df.withColumn(
        "month",
        F.when(first & F.col(spec.group).isin(*spec.lsci_monthly_groups), F.lit(spec.lsci_monthly_to))
        .when(first, F.lit(spec.lsci_others_to))
        .otherwise(F.col("month"))
        .cast("int"),
    )


def index_override(spec: PanelSpec) -> Column:
    g = F.col(spec.group) == F.lit(spec.override_group)
    return override_chain(
        spec.index_col,
        [
            (
                g & (F.col("year") == spec.override_year) & F.col("month").isin(*spec.override_months),
                F.lit(float(spec.override_value)),
            ),
            (g & F.col(spec.index_col).isNull(), F.col(spec.patch_col)),
        ],
    )


def build_panel(
    base: DataFrame,
    prices: DataFrame,
    events: DataFrame,
    index: DataFrame,
    patch: DataFrame,
    gpr: DataFrame,
    lsci: DataFrame,
    target: DataFrame,
    spec: PanelSpec | None = None,
    fill_strategy: str = "bucketed",
    stages: dict | None = None,
) -> DataFrame:
    """Assemble the panel. Inputs:

    base (group, date, ...), prices (date, price cols...), events / index /
    gpr / lsci / target (group, year, month, value col), patch (group, year,
    month, patch col).

    ``stages``, when given, receives the lazy intermediate panels
    ``prices_filled``, ``events_zero_filled`` and ``events_placed``, on which
    the reference runs its outlier checks.
    """
    s = spec or PanelSpec()
    g, d = s.group, s.date
    period = ["year", "month"]
    # 1-2 daily prices, filled over non-trading days; the fills and the
    # placement are all keyed on (group, year), so one hash partitioning
    # serves every window below
    p = left_join(base, prices, [d]).withColumns({"year": F.year(d), "month": F.month(d)})
    p = forward_fill(p, s.price_cols, [g], [d], strategy=fill_strategy, bucket="year", null_groups=False)
    if stages is not None:
        stages["prices_filled"] = p
    # every period source in one wide row per (group, year, month), lsci with
    # its first period remapped, joined once
    merged = merge_periods(
        dict(events=events, index=index, patch=patch, gpr=gpr, lsci=remap_first_period(lsci, s), target=target), [g, *period]
    )
    p = left_join(p, merged, [g, *period])
    # 3 monthly events, missing -> 0
    p = zero_fill(p, [s.events_col])
    later = [c for c in merged.columns if c not in (g, *period, s.events_col)]
    if stages is not None:
        stages["events_zero_filled"] = p.drop(*later)
    if s.flag_event_coverage:
        ym = F.col("year") * 100 + F.col("month")
        cov = events.groupBy(g).agg(F.min(ym).alias("__ev_lo"), F.max(ym).alias("__ev_hi"))
        p = left_join(p, cov, [g])
        p = p.withColumn(
            "events_covered", F.coalesce(ym.between(F.col("__ev_lo"), F.col("__ev_hi")), F.lit(False))
        ).drop("__ev_lo", "__ev_hi")
    # 4 month-end placement
    p = period_end_place(p, s.events_col, [g], period, d)
    if stages is not None:
        stages["events_placed"] = p.drop(*later)
    # 5 monthly index overridden by the patch
    p = p.withColumn(s.index_col, index_override(s)).drop(s.patch_col)
    # 6 period fills of index and lsci in one pass. The reference fills the
    # patched group, then all groups; a fill is idempotent, so one fill of all
    # groups gives the same values.
    p = forward_fill(p, [s.index_col, s.lsci_col], [g], period, strategy=fill_strategy, bucket="year", null_groups=False)
    # 7 cutoff after the fills
    p = p.where(F.col(d) > F.to_date(F.lit(s.cutoff)))
    lead = ["year", "month", g, d]
    return p.select(*lead, *[c for c in p.columns if c not in lead])

"""Command line: ``python -m panelsmith run --landing DIR --out DIR``.

Uses the session that ``spark-submit`` (or the environment) configures; no
master, memory or partition setting is made here.
"""

from __future__ import annotations

import argparse
import json

def _default_gpr_schema() -> str:
    from panelsmith.sources.dims import COUNTRIES

    return "month date, GPR double, " + ", ".join(f"GPRC_{iso} double" for _, iso in COUNTRIES)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="panelsmith")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="normalise, assemble, check, impute and write")
    run.add_argument("--landing", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--gpr-schema", default=None, help="DDL schema of the wide index sheet (default: GPRC_<ISO3> for the 16 groups)")
    run.add_argument("--folds", type=int, default=5)
    run.add_argument("--grid", default=None, help="JSON grid, e.g. '{\"numTrees\": [50], \"maxDepth\": [10], \"featureSubsetStrategy\": [\"log2\"]}'")
    run.add_argument("--row-split", action="store_true", help="split rows at random (reference behaviour) instead of by period")
    run.add_argument("--csv", action="store_true", help="also write the panel and the final table as CSV")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from panelsmith.plans.pipeline import run_pipeline

    spark = SparkSession.builder.appName("panelsmith").getOrCreate()
    grid = json.loads(args.grid) if args.grid else None
    split_keys = ("country", "date") if args.row_split else ("year", "month")
    schema = args.gpr_schema or _default_gpr_schema()
    res = run_pipeline(
        spark, args.landing, args.out, schema, grid=grid, folds=args.folds, split_keys=split_keys, csv=args.csv
    )
    for r in res.imputation.null_counts.collect():
        print(f"{r.stage}: {r.n_null_rows} of {r.n_rows} rows with a missing value")


if __name__ == "__main__":
    main()

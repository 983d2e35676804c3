"""Every registered query against its DuckDB SQL on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import datetime as dt
import math

import duckdb
import pytest

from panel_cases import SMALL
from panelsmith.plans import registry
from panelsmith.session import TABLES

registry.load_all()
ML = {"rf_cv", "feature_importance", "impute_forest", "impute_panel"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, con, name):
    sdf = registry.QUERIES[name](spark, SMALL)
    rel = con.sql(registry.ORACLE[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert _canon(sdf.columns, sdf.collect()) == _canon(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE) - ML))
def test_rows_only_queries_run(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() >= 0


DUCK_TO_SPARK = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint",
}


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_types_match_sql(spark, con, name):
    sdf = registry.QUERIES[name](spark, SMALL)
    rel = con.sql(registry.ORACLE[name])
    spark_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    duck_types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types

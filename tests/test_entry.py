"""The driver contract: entry() smoke check and every query against its DuckDB twin."""

import os

import duckdb
import pytest

import __spark_entry__ as ent
from tools.oracle_check import TABLES, digest

from conftest import SF_SMALL


def test_entry_schema(spark):
    df = ent.entry(spark)
    assert df.columns == ["passenger_id", "arrival_airport_code", "arrival_city", "arrival_country",
                          "score", "generated_at"]
    rows = df.collect()
    assert rows
    per_user = {}
    for r in rows:
        per_user[r.passenger_id] = per_user.get(r.passenger_id, 0) + 1
    assert max(per_user.values()) <= 5


def test_every_sql_query_has_a_spark_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ent.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ent.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


@pytest.fixture()
def aqe_off(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("name", sorted(set(ent._QUERIES) - {
    "als_recommendations_orders", "als_recommendation_counts_orders", "als_eval"}))
def test_builds_without_adaptive_execution(aqe_off, name):
    # Plans are analysed while they are built; a caller's session may run without AQE.
    df = ent.queries()[name](aqe_off, SF_SMALL)
    assert df.schema.fields


def test_fair_report_without_adaptive_execution(aqe_off):
    from wayfare.operators.evaluate import evaluation_report
    rep = evaluation_report(ent._indexed(aqe_off, SF_SMALL).indexed, fair_baseline=True).collect()
    assert len(rep) == 1

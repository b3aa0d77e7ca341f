"""Every query with SQL against DuckDB on the small tables; the others run and give rows."""

import datetime
import math
import os

import duckdb
import pytest

from panelwright.plans import registry

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def cells(rows):
    def one(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return "~"
        return repr(round(float(x), 6)) if isinstance(x, int | float) and not isinstance(x, bool) else str(x)

    return sorted(tuple(map(one, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df, rel = QUERIES[name](spark, DATA), duck.sql(SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    want = duck.sql(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall()
    assert cells(df.select(*cols).collect()) == cells(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_daily_grid_has_every_series_and_day(spark, tmp_path):
    for name, key in (("lineitem", "l_partkey"), ("part", "p_partkey")):
        spark.read.parquet(f"{DATA}/{name}.parquet").where(f"{key} < 12").write.parquet(f"{tmp_path}/{name}.parquet")
    lines = duckdb.sql(f"SELECT l_partkey, CAST(l_shipdate AS DATE), sum(l_quantity) FROM '{DATA}/lineitem.parquet' WHERE l_partkey < 12 AND CAST(l_shipdate AS DATE) < DATE '2001-06-21' GROUP BY ALL").fetchall()
    want = {}
    for sku in {r[0] for r in lines}:
        sold = {day: float(x) for k, day, x in lines if k == sku}
        day, x = max(sold), None
        while day >= min(sold):
            want[sku, day] = x = sold.get(day, x)
            day -= datetime.timedelta(1)
    got = {(r.sku_id, r.dt): r.x for r in QUERIES["c16_daily_grid_whole"](spark, str(tmp_path)).collect()}
    assert len({sku for sku, _ in want}) == 12 and got == pytest.approx(want)

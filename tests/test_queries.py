"""Registered queries against their SQL. THALWEG_ALL_QUERIES=1 runs every one; by default those without loops."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from thalweg.plans import registry as H

SF = "/root/testdata/sf0.001"
SLOW = ("flt_relate", "sp_intersection", "sp_difference", "sp_union", "fc_bank", "fc_skeleton", "fc_pipeline", "g_dijkstra_path", "g_straightest", "g_no_cycle", "srt_by_path", "snk_order", "pp_", "agg_component_size", "lim_traversal_cap", "ra_d", "g_orders_legacy", "g_shreve", "g_strahler")
NAMES = [n for n in H.ORACLE_SQL if os.environ.get("THALWEG_ALL_QUERIES") or not n.startswith(SLOW) or n in ("pp_unique_check", "pp_reach", "ra_distance_grid")]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return [plain(x) for x in v] if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    result = db.sql(H.ORACLE_SQL[name])
    assert sorted(result.columns) == columns
    place = [result.columns.index(c) for c in columns]
    want = [tuple(plain(r[i]) for i in place) for r in result.fetchall()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_the_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0].hop == 0


def test_queries_and_sql_agree_on_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Driver contract: entry runs, catalog keys have oracles where claimed, sample oracle matches."""

import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL

def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "delayed" in df.columns and "route_id_encoded" in df.columns


def test_oracle_coverage():
    from tarmac.plans.catalog import QUERIES
    o = E.oracle_sql()
    assert set(o) <= set(E.queries())
    assert set(QUERIES) <= set(o)


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def test_selected_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in ("orders", "events", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("engineer_features", "split_assign", "quality_report", "roc_auc", "daily_drift",
                 "compare_champion"):
        sdf = E.queries()[name](spark, SF_SMALL)
        cur = con.execute(E.oracle_sql()[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        assert sorted(sdf.columns) == sorted(dcols), name
        order = [dcols.index(c) for c in sdf.columns]
        drows = [tuple(r[i] for i in order) for r in drows]
        assert _norm([tuple(r) for r in sdf.collect()]) == _norm(drows), name

"""Every registered query against its DuckDB oracle on the smallest scale."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from sessionlens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_sql_query_has_an_oracle_or_is_ml():
    q, s = E.queries(), E.oracle_sql()
    missing = sorted(set(q) - set(s))
    other = re.compile(r"purchase_|op\d+_|pipeline$|.*_approx$")  # ML and training data have tests of their own
    assert all(other.match(k) for k in missing), missing
    assert set(s) <= set(q)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert _bag(df.columns, got) == _bag(want_cols, want)


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 2
    assert {r.device_type for r in rows} == {"Mobile", "Desktop"}


def test_approximate_modes_stay_close(spark):
    q = E.queries()
    approx = q["rfm_scores_approx"](spark, SF).collect()
    exact = q["rfm_scores"](spark, SF).collect()
    assert len(approx) == len(exact) == 150
    agree = sum(a.rfm_score == b.rfm_score for a, b in
                zip(sorted(approx, key=lambda r: r.user_id), sorted(exact, key=lambda r: r.user_id)))
    assert agree >= 0.5 * len(exact)
    prof = {r.column_name: r for r in q["data_quality_approx"](spark, SF).collect()}
    assert prof["session_id"].distinct_count >= 0.9 * 1500 and prof["device_type"].distinct_count == 2


def test_invariants(spark):
    q = E.queries()
    users = q["user_metrics"](spark, SF).count()
    assert sum(r["count"] for r in q["segment_distribution"](spark, SF).collect()) == users
    assert sum(r["count"] for r in q["rfm_distribution"](spark, SF).collect()) == users
    ret = q["cohort_retention"](spark, SF).collect()
    assert all(r.retention_rate == 100.0 for r in ret if r.months_since_first == 0)
    per_user = {r.user_id: r.total_sessions for r in q["user_metrics"](spark, SF).collect()}
    top = {}
    for r in q["session_number"](spark, SF).collect():
        top[r.user_id] = max(top.get(r.user_id, 0), r.session_number)
    assert top == per_user
    totals = {name: sum(r.sessions if hasattr(r, "sessions") else r["count"] for r in q[name](spark, SF).collect())
              for name in ("chart_sessions_by_hour", "chart_sessions_by_day")}
    assert len(set(totals.values())) == 1

"""Registered queries against their DuckDB twins on the smallest data."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E

FAST = ["book_wide", "book_arrays", "ofi_features", "moment_features", "feature_table",
        "resample_last", "sliding_windows", "sequence_samples", "time_split", "walk_forward_folds",
        "labels_ternary", "class_weights", "kelly_sizing", "ledger_reference", "ledger_mtm",
        "threshold_search_sortino", "backtest_metrics", "rolling_metrics", "eval_report",
        "eval_pred_dist", "describe_features", "label_summary"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return c


def rows(df):
    out = []
    for r in df[sorted(df.columns)].itertuples(index=False):
        out.append(tuple("NULL" if v is None or (isinstance(v, float) and v != v) else
                         (v.isoformat() if hasattr(v, "isoformat") else str(v)) for v in r))
    return sorted(out)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert list(s.columns) == list(d.columns)
    assert len(s) == len(d)
    assert rows(s) == rows(d)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["symbol", "label", "n", "mean_weighted_imbalance", "mean_ofi_rolling"]

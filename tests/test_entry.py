import __spark_entry__ as E
from conftest import SF_SMALL


def test_registry_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 90


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "dataset" in df.columns and "010_001" in df.columns
    assert df.count() > 0


def test_oracle_subset_small(spark):
    """A fast subset of the oracle gate on sf0.001 (the full gate runs at sf0.01)."""
    import duckdb
    from tools.check_oracle import digest
    from tenderlens.sources.views import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    for name in ["calculate_target", "bin_index", "restructure", "fill_median", "upsert_by_key", "ecdf_table",
                 "histogram", "tfidf_top_terms", "metrics_by_model_target"]:
        df = qs[name](spark, SF_SMALL)
        res = con.execute(sql[name])
        ocols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(ocols), name
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(ocols, res.fetchall())[0], name

"""The model table's targets, written as one array, are the plan's columns."""

from pyspark.sql import functions as F

from tenderlens.operators import modeldata
from tenderlens.plans import tender as TP
from tenderlens.session import cut_lineage


def _tables(spark):
    notices = [(i, f"title {i}", "a/b" if i % 3 else "c", "x" if i % 2 else "", 1000.0 + i, 990.0, ["+3%~-3%", "+2%~-2%", "+0% ~ -6%"][i % 3],
                50.0, 87.5, 3, None if i % 4 else "m") for i in range(1, 31)]
    bids = [(i, f"{'-' if (i * j) % 2 else ''}{j % 3}.{(7 * i + j) % 100:02d} ({j})") for i in range(1, 29) for j in range(1 + 40 * (i % 2))]
    cols = TP.TenderColumns()
    n = spark.createDataFrame(notices, ", ".join(f"`{c}` {t}" for c, t in zip(
        [cols.key, cols.title, cols.agency, cols.region, cols.base, cols.estimate, cols.range_text, cols.a_value, cols.bid_rate, cols.n_bidders, cols.mark],
        ["long", "string", "string", "string", "double", "double", "string", "double", "double", "long", "string"])))
    return n, spark.createDataFrame(bids, f"`{cols.key}` long, `{cols.rate_text}` string"), cols


def test_packed_targets_are_the_columns(spark):
    n, b, cols = _tables(spark)
    for form in ("columns", "positions"):
        plain, packed = TP.transform(n, b, form=form), TP.transform(n, b, form=form, packed=True)
        assert TP.PACKED in packed.columns and len(packed.columns) < 40
        wide = TP.read_targets(cut_lineage(packed))
        assert wide.columns == plain.columns and [f.metadata for f in wide.schema] == [f.metadata for f in plain.schema]
        assert sorted(map(str, wide.collect())) == sorted(map(str, plain.collect()))
        assert wide.count() == 28 and wide.where(F.abs(sum(F.col(f"`010_{i:03d}`") for i in range(1, 11)) - 1) > 1e-9).count() == 0


def test_written_base_of_a_packed_table_holds_maps(spark):
    n, b, _ = _tables(spark)
    plan = TP.transform(n, b, packed=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "__m" in plan and "010_001" not in plan


def test_blobs_survive(spark):
    import numpy as np

    v = np.arange(12.0).reshape(4, 3)
    assert (modeldata.from_blobs(modeldata.blobs(v).slice(1, 2), np.float64) == v[1:3]).all()

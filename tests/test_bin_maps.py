"""Cells of a key add up its rows, which are gathered by all their bins together and not cell by cell."""

from collections import Counter

from tenderlens.operators import bins as B

ROWS = [("a", x / 7 - 1, 1 + x % 3) for x in range(15)] + [("a", 0.3, 2), ("a", 0.31, 5), ("b", -3.0, 4), (None, 0.5, 1)]


def binned(spark):
    d = spark.createDataFrame(ROWS, "k string, x double, w long").selectExpr("*", "0 AS lvl", "-1.0D AS lo", "1.0D AS hi")
    return B.add_bin_columns(d, "x", "lvl", "lo", "hi", {})


def test_cells_are_weighted_sums(spark):
    rows = binned(spark).collect()
    off, want, total = B.cell_offsets(), {}, Counter()
    for r in rows:
        total[r["k"]] += r["w"]
        for n in B.GRANULARITIES:
            want.setdefault(r["k"], Counter())[off[n] + r[f"__b{n}"] - 1] += r["w"]
    got = {r["k"]: r for r in B.bin_maps(binned(spark), ["k"], weight="w").collect()}
    assert {k: dict(r["__m"]) for k, r in got.items()} == {k: dict(c) for k, c in want.items()}
    assert {k: r["__total"] for k, r in got.items()} == dict(total)


def test_no_row_per_cell(spark):
    """Every bid used to be exploded to a row for each granularity before the rows were counted and gathered."""
    plan = B.bin_maps(binned(spark), ["k"], weight="w")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan

from pyspark.sql import functions as F

from tenderlens.functions.expr import GRANULARITIES, target_name
from tenderlens.operators import bins as B

XS = [-3.5, -3.0, -2.4, 0.0, 2.4, 3.0, 3.5]
EXPECTED = {10: [1, 1, 2, 6, 10, 10, 10], 20: [1, 1, 3, 11, 19, 20, 20],
            50: [1, 1, 6, 26, 46, 50, 50], 100: [1, 1, 11, 51, 91, 100, 100]}


def _df(spark, level):
    return spark.createDataFrame([(i, x, level, -3.0, 3.0) for i, x in enumerate(XS)],
                                 "k int, x double, lvl int, lo double, hi double")


def test_equal_width_bin_index_fixture(spark):
    out = B.add_bin_columns(_df(spark, 0), "x", "lvl", "lo", "hi", {}).orderBy("k").collect()
    for n in GRANULARITIES:
        assert [r[f"__b{n}"] for r in out] == EXPECTED[n], n


def test_fixed_edges_match_equal_width_for_the_rule(spark):
    edges = B.rule_edges()
    out = B.add_bin_columns(_df(spark, 3), "x", "lvl", "lo", "hi", edges).orderBy("k").collect()
    for n in GRANULARITIES:
        assert [r[f"__b{n}"] for r in out] == EXPECTED[n], n


def test_rule_edges_equal_spark_edge_table(spark):
    assert B.collect_edges(B.load_bin_edges(B.edge_file_table(spark))) == B.rule_edges()


def test_equal_width_edges_like_linspace(spark):
    import numpy as np
    d = spark.createDataFrame([(-6.0, 0.0)], "lo double, hi double")
    for n in GRANULARITIES:
        got = d.select(B.equal_width_edges("lo", "hi", n)).first()[0]
        assert got == np.linspace(-6.0, 0.0, n + 1)[1:-1].tolist()


def test_duplicate_edges_count_twice(spark):
    d = spark.createDataFrame([(0.5, 3), (1.5, 3), (2.5, 3)], "x double, lvl int")
    d = d.withColumn("lo", F.lit(0.0)).withColumn("hi", F.lit(1.0))
    out = B.add_bin_columns(d, "x", "lvl", "lo", "hi", {(3, 4): [1.0, 1.0, 2.0]}, (4,)).collect()
    assert [r["__b4"] for r in out] == [1, 3, 4]


def test_shares_sum_to_one_and_nest(spark):
    import random
    rnd = random.Random(3)
    rows = [(k, round(rnd.uniform(-4, 4), 2), 0, -3.0, 3.0) for k in range(20) for _ in range(rnd.randint(1, 9))]
    d = spark.createDataFrame(rows, "k int, x double, lvl int, lo double, hi double")
    w = B.bin_shares_wide(B.add_bin_columns(d, "x", "lvl", "lo", "hi", {}), ["k"]).collect()
    for r in w:
        for n in GRANULARITIES:
            assert abs(sum(r[target_name(n, i)] for i in range(1, n + 1)) - 1) < 1e-12
        # 10 bins nest into 20 and 100 (values on float edges are rare at 2 digits)
        for i in range(1, 11):
            assert abs(r[target_name(10, i)] - r[target_name(20, 2 * i - 1)] - r[target_name(20, 2 * i)]) < 1e-12


def test_long_form_keeps_zeros(spark):
    d = spark.createDataFrame([(1, 0.1), (1, 0.2)], "k int, v double")
    long = B.bin_shares_long(d, ["k"], "v", 0.0, 1.0, 10).collect()
    assert len(long) == 10 and sum(r["share"] for r in long) == 1.0


def test_calculate_target_same_with_hot_keys(spark):
    from conftest import SF_SMALL
    from tenderlens.plans import tender as TP
    from tenderlens.sources import views as V
    n, b = V.notices(spark, SF_SMALL), V.bids(spark, SF_SMALL)
    nt, pb = TP.clean_notices(n), TP.parsed_bids(b)
    hot = [r[0] for r in pb.groupBy("공고번호").count().orderBy(F.desc("count"), "공고번호").limit(3).collect()]
    plain = TP.calculate_target(nt, pb, hot=[])
    salted = TP.calculate_target(nt, pb, hot=hot, salt_buckets=4)
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0

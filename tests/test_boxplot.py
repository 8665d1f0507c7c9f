from curlew.operators import reshape as R


def test_outlier_rows(spark):
    rows = [("a", float(x)) for x in range(10)] + [("a", 100.0), ("a", -50.0), ("a", None), ("b", 1.0), ("c", None)]
    got = R.boxplot_outliers(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()
    # quartiles 1.75 and 7.25 of the twelve values of a
    assert sorted((r["g"], r["v"], r["fence_lo"], r["fence_hi"]) for r in got) == [("a", -50.0, -6.5, 15.5), ("a", 100.0, -6.5, 15.5)]

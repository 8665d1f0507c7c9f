from pyspark.sql import functions as F

from curlew.operators import clean as C

SCHEMA = "id long, entity string, label int"


def test_dedup_and_conflicts(spark):
    rows = [(1, "a b", 1), (2, "A  b", 1), (3, "c", 0), (4, "c", 1), (5, "d", 0), (6, None, 1),
            (7, "e", None), (8, "d", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = C.standardize_key(C.drop_missing(df, ["entity", "label"]), "entity")
    kept = {r.id: r.key for r in C.drop_conflicts(df, "key", "label", "id").collect()}
    # 'a b' twice with the same label -> first row kept; 'c' conflicts -> dropped
    assert kept == {1: "a b", 5: "d"}
    dd = {(r.key, r.label): r.id for r in C.dedup_same_label(df).collect()}
    assert dd == {("a b", 1): 1, ("c", 0): 3, ("c", 1): 4, ("d", 0): 5}


def test_empty_and_all_conflicting(spark):
    empty = spark.createDataFrame([], SCHEMA).withColumn("key", F.col("entity"))
    assert C.drop_conflicts(empty).count() == 0
    allc = spark.createDataFrame([(1, "x", 0), (2, "x", 1), (3, "y", 1), (4, "y", 0)], SCHEMA)
    assert C.drop_conflicts(allc.withColumn("key", F.col("entity"))).count() == 0


def test_line_notation_rules_and_fragments(spark):
    rows = [(1, "OCCN", 1), (2, "n1cccc1O", 0), (3, "CN(C)CCOC2=CC=CC(=C2)F", 1),
            (4, "C1CC(=O)N(C1)CCO", 1), (5, "CC(C", 0), (6, "C C", 0),
            (7, "OC(=O)CCN(C)C.[K+]", 1), (8, "CCN.[Na+].[Br-]", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    v = {r.id: list(r.reject_reasons) for r in C.validate_entities(df, "entity", "line").collect()}
    assert v[1] == [] and v[2] == [] and v[3] == [] and v[4] == []
    assert "unbalanced_parens" in v[5] and "charset" in v[6]
    k = {r.id: r.key for r in C.standardize_key(df, "entity", "fragments").collect()}
    assert k[7] == "OC(=O)CCN(C)C"     # longest fragment
    assert k[8] == "[Br-]"                         # length tie -> smallest string


def test_funnel_counts(spark):
    rows = [(1, "hello world this is long enough", 1), (2, "hello   world this is long enough", 1),
            (3, "short", 0), (4, None, 0), (5, "another valid sentence here ok", 0),
            (6, "another valid sentence here ok", 1)]
    f = {r.stage: r.value for r in C.curation_funnel(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert f == {"original": 6, "after_missing": 5, "after_validation": 4,
                 "after_standardization": 4, "after_dedup": 3, "after_conflicts": 1}

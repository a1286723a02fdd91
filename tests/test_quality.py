import pytest

from lakeforge.operators import quality as Q


def test_each_check_kind(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (2, None, -1.0), (None, "z", 200.0)],
                               "id int, v string, x double")
    assert Q.unique_failures(df, "id").collect()[0]["n_records"] == 2
    assert Q.not_null_failures(df, "v").count() == 1
    bad = {r["v"]: r["n_records"] for r in Q.accepted_values_failures(df, "v", ["a", "b"]).collect()}
    assert bad == {"z": 1}
    assert Q.expression_failures(df, "x > 0").count() == 1  # NULL is not a failure
    assert Q.expression_failures(df, "x between 0 and 100", where="x is not null").count() == 2
    parent = spark.createDataFrame([(1,)], "id int")
    assert Q.relationships_failures(df, "id", parent, "id").count() == 1


def test_suite_summary_and_gate(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (3, None)], "id int, pid int")
    parent = spark.createDataFrame([(1, "a"), (2, None)], "pid int, v string")
    checks = [Q.Check("unique", "child", "id"), Q.Check("not_null", "child", "pid"),
              Q.Check("relationships", "child", "pid", to_table="parent", to_column="pid"),
              Q.Check("accepted_values", "parent", "v", values=("b",)),
              Q.Check("expression", "parent", "pid", expression="pid > 0")]
    summary = Q.run_suite({"child": child, "parent": parent}, checks)
    got = {(r["table_name"], r["column_name"], r["test_name"]): r["failures"] for r in summary.collect()}
    assert got == {("child", "id", "unique"): 1, ("child", "pid", "not_null"): 1,
                   ("child", "pid", "relationships"): 2, ("parent", "v", "accepted_values"): 1,
                   ("parent", "pid", "expression"): 0}
    with pytest.raises(Q.QualityError):
        Q.assert_suite(summary)
    ok = Q.run_suite({"parent": parent}, [Q.Check("expression", "parent", "pid", expression="pid > 0")])
    assert Q.assert_suite(ok)[0]["failures"] == 0


def test_default_suite_has_reference_shape():
    suite = Q.default_suite()
    assert len(suite) == 19
    kinds = [c.kind for c in suite]
    assert kinds.count("unique") == 2 and kinds.count("not_null") == 11
    assert kinds.count("accepted_values") == 2 and kinds.count("expression") == 3
    assert kinds.count("relationships") == 1

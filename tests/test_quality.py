import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import quality as Q
from tallyhawk.plans.dataset import model_dataset
from tallyhawk.plans.queries_history import clean_view
from tallyhawk.plans.queries_profile import dirty_model


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return model_dataset(clean_view(spark, sf_dir)).cache()


def results(checks):
    return {r["check"]: r for r in checks.collect()}


def test_own_dataset_passes_every_suite(model):
    for checks in (Q.final_checks(model, 1000), Q.behaviour_checks(model),
                   Q.readiness_checks(model)):
        rows = checks.collect()
        assert [r.position for r in sorted(rows)] == list(range(1, len(rows) + 1))
        assert all(r.passed for r in rows), [r for r in rows if not r.passed]
    assert len(results(Q.final_checks(model, 1000))) == 12
    assert len(results(Q.behaviour_checks(model))) == 11


def test_wrong_data_is_found(spark, sf_dir):
    found = results(Q.final_checks(dirty_model(spark, sf_dir), 999))
    failed = {name for name, r in found.items() if not r.passed}
    assert len(failed) == 9
    assert found["Row count matches expected dataset size"].violations == 1
    assert "lat: " in found["Values within expected ranges"].detail
    assert "customer_hist_std_amt inf" in (
        found["Numeric columns contain only finite, valid values"].detail)


def test_missing_columns_fail_groups_and_skip_the_rest(model):
    slim = model.select("trans_num", "amt", "is_fraud")
    found = results(Q.final_checks(slim, 1000))
    assert not found["Required columns present"].passed
    assert not found["Location-change features internally valid"].passed
    assert found["Values within expected ranges"].passed
    behaviour = results(Q.behaviour_checks(slim))
    assert behaviour["night_transaction matches trans_hour window (22:00-05:59)"].passed
    assert not behaviour["rapid_transaction_flag matches 5-minute rule"].passed


def test_null_rules(spark):
    df = spark.createDataFrame([(None, None), (1, -1.0), (2, float("inf")), (0, float("nan"))],
                               "is_fraud int, amt double")
    found = results(Q.final_checks(df, 4))
    # Null breaks membership, but null is not negative.
    assert found["'is_fraud' target column exists and is binary"].violations == 2
    assert found["No unexpected negative values"].violations == 1
    assert found["No missing values"].violations == 3
    ready = results(Q.readiness_checks(df))
    assert ready["Target contains only 0/1"].violations == 1


def test_text_in_a_number_column_is_a_violation(spark):
    df = spark.createDataFrame([("M", 1), ("0", 0)], "gender string, is_fraud int")
    found = results(Q.final_checks(df, 2))
    assert not found["Numeric feature columns have numeric dtypes"].passed
    assert found["Binary flag columns contain only 0/1"].violations == 1


def test_duplicates_and_empty_table(spark, model):
    twice = model.unionByName(model.limit(3))
    assert results(Q.behaviour_checks(twice))["No duplicate rows"].violations == 3
    empty = results(Q.readiness_checks(model.limit(0)))
    assert not empty["Dataset is not empty"].passed and empty["No duplicate rows"].passed


def test_verdict_and_lines(spark, model, sf_dir):
    good = Q.verdict(Q.behaviour_checks(model)).first()
    assert (good.all_passed, good.failed, good.checks) == (True, 0, 11)
    bad = Q.behaviour_checks(dirty_model(spark, sf_dir))
    assert not Q.verdict(bad).first().all_passed
    lines = [r.line for r in Q.check_lines(bad).orderBy("position").collect()]
    assert lines[0].startswith("  [PASS] Required") and any("[FAIL]" in x for x in lines)


def test_presence_of_summary_groups(spark):
    df = spark.createDataFrame([(1, 2)], "location_changed int, customer_median_amt int")
    rows = {r.feature_group: r for r in Q.feature_group_presence(df).collect()}
    assert rows["Location Change"].found == ["location_changed"]
    assert rows["Large Amount"].missing[0] == "amount_deviation" and len(rows) == 4


def test_rules_are_checked_in_one_pass(spark):
    df = spark.createDataFrame([(-1.0, 95.0)], "amt double, lat double")
    plan = Q.run_checks(df, [Q.Check("a", {"x": F.col("amt") < 0}),
                             Q.Check("b", {"y": F.col("lat") > 90})])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate") == 1


def test_bad_values_are_listed_with_their_rows(spark):
    df = spark.createDataFrame(
        [(2, 1.0), (2, 1.0), (None, -3.0), (1, -3.0), (0, None)], "is_fraud int, amt double")
    rules = [
        Q.Check("binary", {"is_fraud": Q.not_in("is_fraud", 0, 1)}),
        Q.Check("signs", {"amt below": Q.negative("amt")}),
        Q.Check("absent", {"gone": Q.negative("amt")}, needs=["gone"]),
        Q.Check("known", known=(False, 1, "")),
    ]
    found = {(r["check"], r["columns"][0], r["values"][0]): r["rows"]
             for r in Q.bad_value_counts(df, rules).collect()}
    assert found == {("binary", "is_fraud", "2"): 2, ("binary", "is_fraud", None): 1,
                     ("signs", "amt", "-3.0"): 2}
    assert Q.bad_value_counts(df.limit(0), rules).collect() == []
    none = Q.bad_value_counts(df, rules[2:])
    assert none.collect() == []
    assert none.dtypes == Q.bad_value_counts(df, rules).dtypes


def test_listed_rows_add_up_to_the_violations(spark, sf_dir):
    df = dirty_model(spark, sf_dir)
    for rules in (Q.final_rules(df, 999), Q.behaviour_rules(df)):
        listed = {}
        for r in Q.bad_value_counts(df, rules).collect():
            listed[r["position"]] = listed.get(r["position"], 0) + r["rows"]
        for r in Q.run_checks(df, rules).collect():
            if rules[r.position - 1].broken:
                assert listed.get(r.position, 0) == r.violations, r


def test_repeated_rows_by_hash(spark):
    from tallyhawk.operators.cleaning import duplicate_rows
    from tallyhawk.operators.profiling import overview
    rows = [("a", None), (None, "a"), ("a", None), ("", None), (None, None), (None, ""), ("a", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert duplicate_rows(df).first()["duplicates"] == 2
    assert overview(df).first().asDict() == {"rows": 7, "columns": 2, "duplicate_rows": 2, "nulls": 8}
    assert overview(df.limit(0)).first().asDict() == {
        "rows": 0, "columns": 2, "duplicate_rows": 0, "nulls": 0}

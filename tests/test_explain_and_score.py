import pytest
from pyspark.sql import functions as F

from tallyhawk import schema as S
from tallyhawk.operators import explain as X, modeling as M, scoring
from tallyhawk.operators.encode import align, fit_levels, level_codes, one_hot, vector_input
from tallyhawk.plans.dataset import engineer_features, model_dataset, prepare_transactions
from tallyhawk.plans.driver_view import raw_transactions
from tallyhawk.plans.queries_history import clean_view


def test_contributions_order_labels_and_reasons(spark):
    df = spark.createDataFrame([("t", 3.0, 1, 2.0, 0.0, 1.5)],
                               "id string, amt double, hour int, age double, x double, y double")
    weights = {"amt": 0.1, "hour": -0.3, "age": 0.15, "x": 1.0, "y": 0.00002}
    out = X.add_explanation(df, X.linear_contributions(weights, dict.fromkeys(weights, 0.0))).first()
    listed = [(c.feature, c.shap_value, c.impact) for c in out.contributions]
    # Equal magnitudes keep feature order; zero decreases; a tiny plus still increases.
    assert listed == [("amt", 0.3, "INCREASES_RISK"), ("hour", -0.3, "DECREASES_RISK"),
                      ("age", 0.3, "INCREASES_RISK"), ("x", 0.0, "DECREASES_RISK"),
                      ("y", 0.0, "INCREASES_RISK")]
    assert [c.label for c in out.contributions][:3] == [
        "Transaction Amount", "Hour of Day", "Cardholder Age"]
    assert [c.feature_value for c in out.contributions][:2] == ["3.0", "1"]
    assert [c.feature for c in out.top_risk_drivers] == ["amt", "age"]
    assert [c.feature for c in out.top_mitigating_factors] == ["hour"]
    assert out.key_reasons[0] == "Transaction Amount contributed +0.30 toward fraud risk"


def test_default_reason_and_at_most_four_drivers(spark):
    df = spark.createDataFrame([("t", 1.0)], "id string, amt double")
    quiet = X.add_explanation(df, {"amt": F.lit(-1.0)}).first()
    assert quiet.key_reasons == [X.DEFAULT_REASON] and quiet.top_risk_drivers == []
    many = X.add_explanation(df, {f"f{i}": F.lit(float(i + 1)) for i in range(6)}).first()
    assert [c.feature for c in many.top_risk_drivers] == ["f5", "f4", "f3", "f2"]
    rows = X.explanation_rows(X.add_explanation(df, {"amt": F.lit(-1.0)}), "id", "top_risk_drivers")
    assert rows.count() == 0


def test_explaining_needs_no_shuffle(spark):
    df = spark.createDataFrame([("t", 1.0)], "id string, amt double")
    plan = X.add_explanation(df, {"amt": F.col("amt") * 2})._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_global_importance(spark):
    df = spark.createDataFrame([(0, "trans_hour", 0.2), (1, "amt", 0.5), (2, "city_pop", 0.2)],
                               "position int, feature string, importance double")
    rows = [(r.rank, r.label, r.impact) for r in X.global_importance(df, 2).orderBy("rank").collect()]
    assert rows == [(1, "Amt", "GLOBAL_IMPORTANCE"), (2, "Trans Hour", "GLOBAL_IMPORTANCE")]


def test_scores_and_categories(spark):
    df = spark.createDataFrame([(100.0, 100.0), (80.0, 40.0), (30.0, 31.0), (0.0, 0.0)],
                               "m double, b double")
    rows = scoring.add_risk(df, "m", "b").collect()
    assert [r.risk_category for r in rows] == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    assert rows[1].risk_score == pytest.approx(0.65 * 80 + 0.35 * 40)


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6 + [(None,)], "is_fraud int")
    rows = {r.is_fraud: r for r in scoring.class_weights(df).collect()}
    assert rows[1].balanced_weight == 2.0 and rows[1].positive_weight == 3.0
    assert rows[0].balanced_weight == pytest.approx(8 / 12)
    weighted = scoring.add_class_weight(df).filter("is_fraud = 1").first()
    assert weighted.class_weight == 2.0


def test_model_comparison(spark):
    df = spark.createDataFrame([("m", 1, 1)] * 3 + [("m", 0, 1)] + [("m", 1, 0)] * 2 + [("m", 0, 0)] * 4
                               + [("n", 0, 0)], "model_name string, is_fraud int, prediction int")
    rows = {r.model_name: r for r in scoring.model_comparison(df).collect()}
    assert (rows["m"].tp, rows["m"].fp, rows["m"].fn, rows["m"].tn) == (3, 1, 2, 4)
    assert rows["m"].f1_score == pytest.approx(6 / 9) and rows["n"].f1_score == 0.0


def test_one_hot_and_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("it's",)], "c string")
    levels = fit_levels(df, ["c"])
    assert levels == {"c": ["a", "b", "it's"]}
    hot = one_hot(df, levels)
    assert hot.columns == ["c_b", "c_it's"]
    assert [tuple(r) for r in hot.collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]
    assert [r.c_encoded for r in level_codes(df, levels).collect()] == [1, 0, None, 2]
    with pytest.raises(ValueError):
        fit_levels(df, ["c"], max_levels=1)


def test_align(spark):
    df = spark.createDataFrame([(1.5, None, 9)], "amt double, lat double, extra int")
    out = align(df, ["lat", "amt", "state_CA"])
    assert out.columns == ["lat", "amt", "state_CA"] and tuple(out.first()) == (0.0, 1.5, 0)


def test_feature_names_of_the_model_schema():
    assert len(S.MODEL_FEATURES) == 102 == len(set(S.MODEL_FEATURES))
    assert S.MODEL_FEATURES[0] == "amt" and S.MODEL_FEATURES[36] == "rapid_transaction_flag"
    assert S.MODEL_FEATURES[37] == "category_food_dining"
    assert S.MODEL_FEATURES[-1] == "Payment_Method_Mobile Payment"


def test_feature_builds(spark, sf_dir):
    df = prepare_transactions(raw_transactions(spark, sf_dir))
    assert df.filter("merch_zipcode is null").count() == 0
    built = engineer_features(df, S.MODEL_LEVELS)
    # 9 base and 9 engineered columns, 65 dummies and the target.
    assert len(built.columns) == 84 and built.columns[-1] == S.TARGET
    model = model_dataset(df)
    assert model.columns == [S.TXN, *S.MODEL_FEATURES, S.TARGET]
    assert model.count() == 1000
    both = built.columns[:9]
    assert set(both) <= set(model.columns)


@pytest.fixture(scope="module")
def vectors(spark, sf_dir):
    df = scoring.add_class_weight(model_dataset(clean_view(spark, sf_dir)))
    return vector_input(df).select(S.TXN, S.TARGET, "class_weight", "features").cache()


def test_split_is_stable_and_complete(vectors):
    train, test = M.stratified_split(vectors)
    again, _ = M.stratified_split(vectors.repartition(7))
    ids = {r[0] for r in train.select(S.TXN).collect()}
    assert ids == {r[0] for r in again.select(S.TXN).collect()}
    assert len(ids) + test.count() == 1000 and 740 < len(ids) < 860


def test_models_score_and_rank(spark, vectors):
    train, test = M.stratified_split(vectors)
    forest = M.train(M.random_forest(trees=5, depth=4), train)
    boosted = M.train(M.boosted_trees(rounds=2, depth=3), train)
    scored = M.score(forest, test, "random_forest").unionByName(M.score(boosted, test, "xgboost"))
    assert scored.count() == 2 * test.count()
    assert scored.filter("probability < 0 or probability > 1").isEmpty()
    assert scoring.model_comparison(scored).count() == 2
    table = M.importance_table(M.importances(boosted, spark), M.importances(forest, spark))
    assert table.count() == 102
    line = M.train(M.logistic(maxIter=3), train)
    assert set(M.linear_coefficients(line, S.MODEL_FEATURES)) == set(S.MODEL_FEATURES)


def test_scaler_uses_training_rows(spark, vectors):
    from pyspark.ml.functions import vector_to_array

    train, _ = M.stratified_split(vectors)
    scaled = M.fit_scaler(train).transform(train)
    mean = scaled.select(F.avg(vector_to_array("scaled")[0])).first()[0]
    assert mean == pytest.approx(0.0, abs=1e-9)


def test_default_settings_of_the_models():
    forest, boosted = M.random_forest(), M.boosted_trees()
    assert (forest.getNumTrees(), forest.getSeed()) == (200, 42)
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getMaxDepth()) == (300, 0.1, 6)


def test_rows_keep_their_nodes_and_the_forest_stays_the_same(spark):
    from pyspark.ml.linalg import Vectors

    from tallyhawk.plans.queries_risk import _ESTIMATORS

    forest = _ESTIMATORS["random_forest"]()
    assert forest.getCacheNodeIds() and (forest.getNumTrees(), forest.getMaxDepth()) == (200, 30)
    rows = [(f"t{i}", int(i * 7919 % 101 < 20), 1.0 + i % 3, Vectors.dense([i % 5, i * 31 % 97, i % 11, 1.0]))
            for i in range(600)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, ["trans_num", "is_fraud", "class_weight", "features"]).coalesce(2).cache()
    forest = forest.setNumTrees(6).setMaxDepth(12)
    kept, walked = (M.train(e, df).stages[-1] for e in (forest, forest.copy().setCacheNodeIds(False)))
    assert kept.totalNumNodes > 100
    # The first line holds the model's own id.
    assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_both_models_are_trained_side_by_side(spark, sf_dir, monkeypatch):
    from threading import Barrier

    from tallyhawk.plans import queries_risk as Q

    # Breaks if one model waits for the end of the other.
    both = Barrier(2, timeout=60)
    seen = []

    def train(estimator, rows):
        seen.append((type(estimator).__name__, rows.count()))
        both.wait()
        return type(estimator).__name__

    def importances(model, spark):
        return spark.createDataFrame([(0, "amt", float(len(model)))], "position int, feature string, importance double")

    parts = spark.range(7), spark.range(2)
    monkeypatch.setattr(Q, "_TRAINED", {})
    monkeypatch.setattr(Q, "_parts", lambda spark, sf_dir: parts)
    monkeypatch.setattr(M, "train", train)
    monkeypatch.setattr(M, "importances", importances)
    names = ("GBTClassifier", "RandomForestClassifier")
    for _ in range(2):
        row = Q._importance(spark, sf_dir).first()
        assert (row["xgboost_importance"], row["random_forest_importance"]) == tuple(float(len(n)) for n in names)
    # The second time both are there.
    assert sorted(seen) == [(n, 7) for n in names]
    assert not parts[0].coalesce(1).storageLevel.useMemory


def test_a_failure_of_a_model_is_raised(spark):
    def fails():
        raise ValueError("no rows")

    assert M.side_by_side(spark, {"a": lambda: 1}) == {"a": 1}
    with pytest.raises(ValueError, match="no rows"):
        M.side_by_side(spark, {"a": lambda: 1, "b": fails})


def test_nodes_are_stored_every_few_levels_and_the_forest_stays_the_same(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    from tallyhawk.plans.queries_risk import _ESTIMATORS

    forest = _ESTIMATORS["random_forest"]()
    assert forest.getCheckpointInterval() == 3
    rows = [(int(i * 7919 % 101 < 20), 1.0 + i % 3, Vectors.dense([i % 5, i * 31 % 97, i % 11])) for i in range(400)]
    df = spark.createDataFrame(rows, ["is_fraud", "class_weight", "features"]).coalesce(2).cache()
    forest = forest.setNumTrees(4).setMaxDepth(9)
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    often, seldom = (M.train(e, df).stages[-1] for e in (forest, forest.copy().setCheckpointInterval(10)))
    # The first line holds the model's own id.
    assert often.toDebugString.split("\n")[1:] == seldom.toDebugString.split("\n")[1:]


def test_large_training_tables_are_dealt_evenly(spark, tmp_path, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from tallyhawk.plans import queries_risk as Q

    def sizes(df):
        return df.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()

    def places(df):
        return df.rdd.mapPartitions(lambda part: [[tuple(r) for r in part]]).collect()

    rows = [(f"t{i}", i % 2, 1.0, Vectors.dense([i % 5, i % 7])) for i in range(900)]
    rows += rows[:40] + [(None, 0, 1.0, Vectors.dense([i % 3, 2])) for i in range(60)]
    names = ["trans_num", "is_fraud", "class_weight", "features"]
    # Two files, one of them with most of the rows.
    for part, name in ((rows[:100], "a"), (rows[100:], "b")):
        spark.createDataFrame(part, names).coalesce(1).write.parquet(f"{tmp_path}/rows/{name}")
    stored = spark.read.parquet(f"{tmp_path}/rows/a", f"{tmp_path}/rows/b")
    assert len(sizes(stored)) < 8

    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(Q, "_ROWS_PER_PARTITION", 10)
    monkeypatch.setattr(Q, "_EVEN_ROWS_PER_CORE", 10)
    dealt = Q._dealt(stored)
    found = sizes(dealt)
    assert len(found) == cores and max(found) - min(found) <= 2 and sum(found) == len(rows)
    assert places(dealt) == places(Q._dealt(stored))
    assert sorted(map(repr, sum(places(dealt), []))) == sorted(map(repr, rows))
    # A task holds a bounded number of rows; few rows are left where they are.
    monkeypatch.setattr(Q, "_MOST_ROWS_PER_PARTITION", 50)
    assert len(sizes(Q._dealt(stored))) == cores * -(-len(rows) // (cores * 50))
    monkeypatch.setattr(Q, "_ROWS_PER_PARTITION", 20_000)
    monkeypatch.setattr(Q, "_EVEN_ROWS_PER_CORE", 100_000)
    assert len(sizes(Q._dealt(stored))) == 1

"""Queries on detectors, explanations, scores and models."""

from __future__ import annotations

from functools import partial
from itertools import combinations
from math import ceil, factorial

from pyspark.sql import functions as F

from tallyhawk import schema as S
from tallyhawk.functions.clock import age_years, is_weekend, micros
from tallyhawk.functions.geo import haversine_km
from tallyhawk.operators import attribution as T, detectors as D, explain as X, modeling as M, scoring
from tallyhawk.operators.curves import curve_summary, threshold_curve
from tallyhawk.operators.encode import level_codes, vector_input
from tallyhawk.plans import history_sql as H
from tallyhawk.plans.dataset import model_dataset
from tallyhawk.plans.driver_view import CATEGORIES, raw_transactions, with_raw, with_txn
from tallyhawk.plans.queries_history import clean_view
from tallyhawk.plans.registry import Query, array_sql, round_sql, rounded, rounded_array
from tallyhawk.session import cut_lineage, shared_folder

# --- detectors --------------------------------------------------------------

_DETAILS = {
    "location": ("moved_km", "speed_kmh", "home_km"),
    "amount": ("z_score", "history", "mean"),
    "timing": ("hour", "night_share"),
    "burst": ("count_10m",),
}


def _detector_input(spark, sf_dir):
    return raw_transactions(spark, sf_dir).select(
        S.TXN, S.CARD, S.TIME, S.AMOUNT, "lat", "long", "merch_lat", "merch_long")


def _detector(name: str):
    def build(spark, sf_dir):
        found = D.detect(_detector_input(spark, sf_dir))
        return rounded(found.select(
            S.TXN, *[F.col(name)[f].alias(f) for f in ("flag", "severity", "score")],
            *[F.col(name)["details"][d].alias(d) for d in _DETAILS[name]],
        ))
    return build


_MOVE = H.haversine_sql("merch_lat", "merch_long", "prev_lat", "prev_long")
_HOME_KM = H.haversine_sql("lat", "long", "merch_lat", "merch_long")

_FOUND = f"""night as (
  select *, sum(cast(hr<6 as int)) over past as past_night, avg(amt) over past as avg_past
  from hist window past as (partition by cc_num order by trans_date_trans_time, trans_num
    rows between unbounded preceding and 1 preceding)),
measured as (
  select *, {_MOVE} as moved_km, {_HOME_KM} as home_km,
    ({_MOVE})/greatest((epoch_us(trans_date_trans_time)-epoch_us(prev_ts))/3.6e9,1e0/3600)
      as speed_kmh,
    case when past_rows>0 then (amt-avg_past)
      /greatest(coalesce(past_std,0e0),avg_past*0.25e0,1e0) end as z_score,
    cast(coalesce(past_night,0) as double)/nullif(past_rows,0) as night_share
  from night),
scored as (
  select *,
    case when speed_kmh>900 and moved_km>50 then 95e0 when home_km>500 then 50e0 else 0e0 end
      as location_score,
    case when past_rows=0 and amt>=1000 then 75e0 when z_score>6 then 95e0
      when z_score>3 then 80e0 else 0e0 end as amount_score,
    case when hr<6 and past_rows>=5 and night_share<0.05 then
      case when past_rows>=10 and past_night=0 then 70e0 else 55e0 end else 0e0 end
      as timing_score,
    case when n10>=4 then 95e0 when n10>=3 then 80e0 else 0e0 end as burst_score
  from measured)"""


def _severity_sql(score: str) -> str:
    return (f"case when {score}>=90 then 'CRITICAL' when {score}>=70 then 'HIGH' "
            f"when {score}>=50 then 'MEDIUM' else 'NONE' end")


def _detector_sql(name: str, details: str, *fractions: str) -> str:
    score = f"{name}_score"
    return round_sql(with_txn(
        f"""select trans_num, {score}>0 as flag, {_severity_sql(score)} as severity,
        {score} as score, {details} from scored""", H.HISTORY, _FOUND), "score", *fractions)


def _combined(spark, sf_dir):
    found = D.detect(_detector_input(spark, sf_dir))
    return rounded(found.select(
        S.TXN, "behaviour_score", "behaviour_flags",
        F.size("behaviour_reasons").alias("reasons"),
        F.col("location.explanation").alias("location_reason"),
        F.col("timing.explanation").alias("timing_reason"),
        F.col("burst.explanation").alias("burst_reason"),
    ))


_BEST = "greatest(location_score, amount_score, timing_score, burst_score)"
_FLAGS = "+".join(f"cast({d}_score>0 as int)" for d in D.DETECTORS)

# --- explanations -----------------------------------------------------------

# Weights of the linear score that is explained.
WEIGHTS = {
    "amt": 0.012, "amt_log": -0.4, "distance_km": 0.006, "hour": -0.03, "day_of_week": 0.05,
    "is_weekend": 0.2, "month": 0.1, "age": -0.015, "city_pop": 0.000004,
    "category_encoded": 0.07, "gender_encoded": -0.25,
}


def _explained_input(spark, sf_dir, keep=()):
    df = clean_view(spark, sf_dir)
    coded = level_codes(df, {"category": sorted(CATEGORIES), "gender": ["F", "M"]})
    ts = F.col(S.TIME)
    return coded.select(
        S.TXN, S.AMOUNT, F.log1p(S.AMOUNT).alias("amt_log"),
        haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"))
        .alias("distance_km"),
        F.hour(ts).alias("hour"), F.weekday(ts).alias("day_of_week"),
        is_weekend(ts).alias("is_weekend"), F.month(ts).alias("month"),
        age_years(ts, F.col("dob")).alias("age"), "city_pop",
        "category_encoded", "gender_encoded", *keep,
    )


def _explained(spark, sf_dir):
    df = _explained_input(spark, sf_dir)
    means = X.feature_means(df, list(WEIGHTS))
    return X.add_explanation(df, X.linear_contributions(WEIGHTS, means))


def _contributions(spark, sf_dir):
    rows = X.explanation_rows(_explained(spark, sf_dir), S.TXN)
    return rounded(rows.drop("feature_value"))


def _raw_values(spark, sf_dir):
    rows = X.explanation_rows(_explained(spark, sf_dir), S.TXN)
    return rows.select(S.TXN, "feature", "feature_value")


def _top(column: str):
    def build(spark, sf_dir):
        rows = X.explanation_rows(_explained(spark, sf_dir), S.TXN, column)
        return rounded(rows.select(S.TXN, "rank", "feature", "shap_value"))
    return build


def _reasons(spark, sf_dir):
    df = _explained(spark, sf_dir)
    return df.select(S.TXN, F.posexplode("key_reasons").alias("place", "reason"))


def _labels(spark, sf_dir):
    """Labels of all features in use, and how often each is the strongest one."""
    rows = X.explanation_rows(_explained(spark, sf_dir), S.TXN)
    return rows.groupBy("feature", "label").agg(F.count_if(F.col("rank") == 1).alias("transactions"))


_ENCODED = "cast(dense_rank() over (order by category)-1 as int) as category_encoded"
_EXPLAINED = (
    f"""input as (select trans_num, amt, ln(1+amt) as amt_log, {_HOME_KM} as distance_km,
      cast(hour(trans_date_trans_time) as int) as hour,
      cast(isodow(trans_date_trans_time)-1 as int) as day_of_week,
      cast(isodow(trans_date_trans_time)>=6 as int) as is_weekend,
      cast(month(trans_date_trans_time) as int) as month,
      cast(floor(date_diff('day', dob, cast(trans_date_trans_time as date))/365) as int) as age,
      city_pop, {_ENCODED}, case gender when 'F' then 0 else 1 end as gender_encoded from txn)""",
    "means as (select " + ", ".join(f"avg({c}) as {c}" for c in WEIGHTS) + " from input)",
    "exact as (" + " union all ".join(
        f"""select i.trans_num, {n} as pos, '{c}' as feature, '{X.FRIENDLY_NAMES[c]}' as label,
        (i.{c}-m.{c})*{w!r} as v from input i, means m"""
        for n, (c, w) in enumerate(WEIGHTS.items())) + ")",
    """ranked as (select trans_num, feature, label, round(v,4) as shap_value,
      case when v>0 then 'INCREASES_RISK' else 'DECREASES_RISK' end as impact,
      round(abs(v),4) as magnitude, pos,
      cast(row_number() over (partition by trans_num order by round(abs(v),4) desc, pos) as int)
        as rank from exact)""",
)


def _shown_sql(feature: str) -> str:
    """Fractions with two digits, zeros at the end removed but one."""
    if feature not in ("amt", "amt_log", "distance_km"):
        return f"cast({feature} as varchar)"
    return f"regexp_replace(cast(cast({feature} as decimal(38,2)) as varchar), '(\\.\\d+?)0+$', '\\1')"


def _top_sql(sign: str) -> str:
    return round_sql(with_txn(
        f"""select trans_num, cast(row_number() over (partition by trans_num order by rank) as int)
          as rank, feature, shap_value from ranked where shap_value{sign}0
        qualify row_number() over (partition by trans_num order by rank)<=4""",
        *_EXPLAINED), "shap_value")


# The shapes of two trees; what their leaves give is learnt from the table.
STATED_TREES = (
    ("amt", 150.0, ("hour", 5.0, None, ("distance_km", 60.0, None, None)),
     ("age", 40.0, ("hour", 20.0, None, None), None)),
    ("distance_km", 80.0, ("amt", 60.0, None, ("amt", 120.0, None, None)),
     ("hour", 12.0, ("amt", 200.0, None, None), None)),
)
STATED_FEATURES = ("amt", "hour", "distance_km", "age")


def _stated_contributions(spark, sf_dir):
    """Exact contributions to an ensemble of two trees, beside its base value and margin."""
    df = _explained_input(spark, sf_dir, (S.TARGET,))
    nodes = T.stated_nodes(df, STATED_TREES, STATED_FEATURES, S.TARGET)
    found = T.add_attributions(df, nodes, STATED_FEATURES)
    return rounded(found.select(
        S.TXN, "base_value", "margin",
        *[F.col("attributions")[i].alias(f"{c}_contribution") for i, c in enumerate(STATED_FEATURES)]))


def _stated_sql() -> str:
    """The same from the definition: the mean over all orders in which features become known."""
    counts, cases, values = [], [], []

    def leaf_case(tree, number, path="true"):
        if tree is None:
            name = f"{number}_{len([c for c in counts if c.startswith(f'count(*) filter (where t{number}')])}"
            leaf = name.split("_")[1]
            counts.append(f"count(*) filter (where t{number}={leaf}) as n{name}, "
                          f"coalesce(avg(is_fraud) filter (where t{number}={leaf}), 0e0) as y{name}")
            return leaf, [name]
        feature, threshold, left, right = tree
        low, low_names = leaf_case(left, number)
        high, high_names = leaf_case(right, number)
        return f"case when {feature}<={threshold} then {low} else {high} end", low_names + high_names

    def value(tree, names, known):
        if tree is None:
            return f"y{names[0]}", names[1:], [names[0]]
        feature, threshold, left, right = tree
        low, rest, below = value(left, names, known)
        high, rest, above = value(right, rest, known)
        if feature in known:
            return f"case when {feature}<={threshold} then {low} else {high} end", rest, below + above
        n_low, n_high = (" + ".join(f"n{x}" for x in side) for side in (below, above))
        return f"coalesce((({n_low})*({low})+({n_high})*({high}))/nullif({n_low}+{n_high},0),0e0)", rest, below + above

    def subset(known):
        return "".join(str(int(f in known)) for f in STATED_FEATURES)

    for number, tree in enumerate(STATED_TREES):
        case, names = leaf_case(tree, number)
        cases.append(f"{case} as t{number}")
        for size in range(len(STATED_FEATURES) + 1):
            for known in combinations(STATED_FEATURES, size):
                values.append(f"{value(tree, names, known)[0]} as v{number}_{subset(known)}")
    shares = []
    for feature in STATED_FEATURES:
        others = [f for f in STATED_FEATURES if f != feature]
        terms = [
            f"{factorial(size) * factorial(len(others) - size)}e0/{factorial(len(others) + 1)}"
            f"*(v{t}_{subset((*known, feature))}-v{t}_{subset(known)})"
            for t in range(len(STATED_TREES)) for size in range(len(others) + 1) for known in combinations(others, size)
        ]
        shares.append(f"({' + '.join(terms)})/{len(STATED_TREES)} as {feature}_contribution")
    mean = [f"({' + '.join(f'v{t}_{bits}' for t in range(len(STATED_TREES)))})/{len(STATED_TREES)} as {name}"
            for bits, name in (("0" * len(STATED_FEATURES), "base_value"), ("1" * len(STATED_FEATURES), "margin"))]
    labelled = _EXPLAINED[0].replace("select trans_num,", "select trans_num, is_fraud,", 1)
    return round_sql(with_txn(
        f"select trans_num, {', '.join(mean + shares)} from worth", labelled,
        f"placed as (select *, {', '.join(cases)} from input)",
        f"leaves as (select {', '.join(counts)} from placed)",
        f"worth as (select trans_num, {', '.join(values)} from placed, leaves)",
    ), "base_value", "margin", *[f"{c}_contribution" for c in STATED_FEATURES])


# --- scores -----------------------------------------------------------------


def _weights(spark, sf_dir):
    return rounded(scoring.class_weights(raw_transactions(spark, sf_dir)))


def _rules(spark, sf_dir):
    """Two simple rules compared as if they were models."""
    df = raw_transactions(spark, sf_dir).select(S.AMOUNT, S.TARGET)
    scored = df.select(S.TARGET, F.explode(F.array(
        F.struct(F.lit("amount_rule").alias("model_name"),
                 (F.col(S.AMOUNT) > 150).cast("int").alias("prediction")),
        F.struct(F.lit("low_amount_rule").alias("model_name"),
                 (F.col(S.AMOUNT) > 60).cast("int").alias("prediction")),
    )).alias("_m")).select(S.TARGET, "_m.*")
    return rounded(scoring.model_comparison(scored))


_RULES_SQL = round_sql(with_raw(
    """select model_name, tp, fp, fn, tn, (tp+tn)*1e0/(tp+tn+fp+fn) as accuracy,
      coalesce(tp*1e0/nullif(tp+fp,0),0e0) as "precision",
      coalesce(tp*1e0/nullif(tp+fn,0),0e0) as recall,
      coalesce(2e0*tp/nullif(2*tp+fp+fn,0),0e0) as f1_score
    from (select model_name, count(*) filter (where y and p) as tp,
        count(*) filter (where not y and p) as fp, count(*) filter (where y and not p) as fn,
        count(*) filter (where not y and not p) as tn
      from (select 'amount_rule' as model_name, is_fraud=1 as y, amt>150 as p from raw union all
            select 'low_amount_rule', is_fraud=1, amt>60 from raw) s group by model_name) c"""),
    "accuracy", "precision", "recall", "f1_score")


def _stated_scores(spark, sf_dir):
    """Two stated scores of every transaction, for curves that another engine can repeat."""
    df = raw_transactions(spark, sf_dir).select(S.AMOUNT, S.TARGET)
    return df.select(S.TARGET, F.explode(F.array(
        F.struct(F.lit("amount_score").alias("model_name"), F.least(F.lit(100.0), F.col(S.AMOUNT) / 4).alias("probability")),
        F.struct(F.lit("small_amount_score").alias("model_name"), (100 / (1 + F.col(S.AMOUNT))).alias("probability")),
    )).alias("_m")).select(S.TARGET, "_m.*")


def _curve(spark, sf_dir):
    return rounded(threshold_curve(_stated_scores(spark, sf_dir)))


def _curve_summary(spark, sf_dir):
    return rounded(curve_summary(threshold_curve(_stated_scores(spark, sf_dir))))


def _trained_curves(spark, sf_dir):
    """Both trained models on the test rows: areas under the curves and best thresholds."""
    _models(spark, sf_dir)
    boosted, forest = (_test_scores(spark, sf_dir, n) for n in _ESTIMATORS)
    return rounded(curve_summary(threshold_curve(boosted.unionByName(forest))))


_CURVE = (
    """stated as (select 'amount_score' as model_name, least(100e0, amt/4) as threshold, is_fraud=1 as y from raw
      union all select 'small_amount_score', 100/(1+amt), is_fraud=1 from raw)""",
    """points as (select model_name, threshold, count(*) filter (where y) as positives,
        count(*) filter (where not y) as negatives from stated
      where y is not null and threshold is not null group by 1, 2)""",
    """upto as (select *, cast(sum(positives) over falling as bigint) as tp,
        cast(sum(negatives) over falling as bigint) as fp, cast(sum(positives) over whole as bigint) as p,
        cast(sum(negatives) over whole as bigint) as n from points
      window falling as (partition by model_name order by threshold desc), whole as (partition by model_name))""",
    """curve as (select model_name, threshold, positives, negatives, tp, fp, p-tp as fn, n-fp as tn,
        tp*1e0/(tp+fp) as "precision", coalesce(tp*1e0/nullif(p,0),0e0) as recall,
        coalesce(fp*1e0/nullif(n,0),0e0) as false_positive_rate,
        coalesce(2e0*tp/nullif(2*tp+fp+p-tp,0),0e0) as f1_score from upto)""",
)
_CURVE_SUMMARY = """select model_name, count(*) as thresholds,
    sum(negatives*(2*tp-positives))*1e0/(2e0*max(tp+fn)*max(fp+tn)) as roc_auc,
    sum(positives*"precision")/max(tp+fn) as average_precision, max(f1_score) as best_f1,
    arg_max(threshold, {'f': f1_score, 't': threshold}) as best_threshold from curve group by model_name"""


def _risk(spark, sf_dir):
    found = D.detect(_detector_input(spark, sf_dir)).withColumn(
        "model_score", F.least(F.lit(100.0), F.col(S.AMOUNT) / 4))
    return scoring.add_risk(found, "model_score", "behaviour_score")


def _risk_scores(spark, sf_dir):
    return rounded(_risk(spark, sf_dir).select(S.TXN, "risk_score", "risk_category"))


def _alerts(spark, sf_dir):
    found = scoring.alerts(_risk(spark, sf_dir))
    return rounded(found.select(S.TXN, micros(F.col(S.TIME)).alias("us"),
                                "risk_score", "risk_category"))


_RISK = f"""risk as (
  select trans_num, trans_date_trans_time, least(100e0, amt/4)*0.65e0+{_BEST}*0.35e0 as risk_score
  from scored), rated as (
  select *, case when risk_score>=85 then 'CRITICAL' when risk_score>=60 then 'HIGH'
    when risk_score>=30 then 'MEDIUM' else 'LOW' end as risk_category from risk)"""


def _card(spark, sf_dir):
    """Every transaction of one card, oldest first."""
    df = raw_transactions(spark, sf_dir).select(S.TXN, S.CARD, S.TIME, S.AMOUNT, "category")
    return scoring.card_history(df, "4000000000000008").withColumn(
        S.TIME, micros(F.col(S.TIME)))


# --- models -----------------------------------------------------------------


def _split(spark, sf_dir):
    df = clean_view(spark, sf_dir).select(S.TXN, S.TARGET)
    train, test = M.stratified_split(df)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))


def _vectors(spark, sf_dir):
    df = scoring.add_class_weight(model_dataset(clean_view(spark, sf_dir)))
    return vector_input(df).select(S.TXN, S.TARGET, "class_weight", "features")


# Both models at their stated size. Training is the costly part and the same for all
# queries on the same tables, so a session trains each model once.
_TRAINED: dict[tuple, object] = {}
# A partition of the training rows: what pays for a task, what a core has where an uneven deal
# costs more than dealing anew, and what one task should hold at most.
_ROWS_PER_PARTITION = 20_000
_EVEN_ROWS_PER_CORE = 100_000
_MOST_ROWS_PER_PARTITION = 500_000
_ESTIMATORS = {
    # Hundreds of rounds make a long lineage; it is cut in the shared folder.
    "xgboost": lambda: M.boosted_trees(checkpointInterval=25, maxMemoryInMB=512),
    # Deep trees: each row keeps its node of every tree instead of walking down from the
    # root once a level. The trees are the same. Until the nodes are stored, every task of a
    # level brings the splits of all levels since, so they are stored every few levels.
    "random_forest": lambda: M.random_forest(maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=3),
}


def _key(spark, sf_dir, what: str) -> tuple:
    """Other files mean other models, also under the same path."""
    files = spark.read.parquet(f"{sf_dir}/events.parquet").inputFiles()
    return spark.sparkContext.applicationId, tuple(sorted(files)), what


def _parts(spark, sf_dir):
    """Training and test rows, stored once for the many passes of the training."""
    key = _key(spark, sf_dir, "parts")
    if key not in _TRAINED:
        _TRAINED[key] = M.stratified_split(cut_lineage(_vectors(spark, sf_dir)))
    return _TRAINED[key]


def _dealt(rows):
    """Training rows in partitions of which the cores finish a level together.

    A round is a handful of jobs, so small tables go into few partitions. Large ones are dealt
    evenly, one partition a core or a multiple: the files give a few uneven ones, and then every
    level waits for a last task that runs alone. The order is that of the rows' content, because
    what a tree samples depends on a row's place.
    """
    count, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    if count < cores * _EVEN_ROWS_PER_CORE:
        return rows.coalesce(max(1, count // _ROWS_PER_PARTITION))
    waves = ceil(count / (cores * _MOST_ROWS_PER_PARTITION))
    return rows.repartition(cores * waves).sortWithinPartitions(S.TXN, F.xxhash64(S.TARGET, "features"))


def _models(spark, sf_dir, names=tuple(_ESTIMATORS)):
    """Models by name, those not trained yet side by side on the same stored rows."""
    keys = {name: _key(spark, sf_dir, name) for name in names}
    missing = [name for name in names if keys[name] not in _TRAINED]
    if missing:
        train = _dealt(_parts(spark, sf_dir)[0]).persist()
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
        fit = {keys[name]: partial(M.train, _ESTIMATORS[name](), train) for name in missing}
        _TRAINED.update(M.side_by_side(spark, fit))
        train.unpersist()
    return {name: _TRAINED[key] for name, key in keys.items()}


def _model(spark, sf_dir, name):
    return _models(spark, sf_dir, (name,))[name]


def _test_scores(spark, sf_dir, name):
    return M.score(_model(spark, sf_dir, name), _parts(spark, sf_dir)[1], name)


def _scaled(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    train, test = M.stratified_split(_vectors(spark, sf_dir))
    scaled = M.fit_scaler(train).transform(test)
    return scaled.select(S.TXN, rounded_array(vector_to_array("scaled")).alias("scaled"))


_SPLIT = """cast('0x'||substr(md5('42|'||is_fraud||'|'||trans_num),1,8) as bigint)%1000000<800000"""
_SCALED_SQL = with_txn(
    "select trans_num, " + array_sql([
        f'case when s{i}=0 then 0e0 else (cast("{c}" as double)-m{i})/s{i} end'
        for i, c in enumerate(S.MODEL_FEATURES)
    ]) + f" as scaled from model, learnt where not ({_SPLIT})", *H.PARTS, H.MODEL,
    "learnt as (select " + ", ".join(
        f'avg(cast("{c}" as double)) as m{i}, stddev_samp(cast("{c}" as double)) as s{i}'
        for i, c in enumerate(S.MODEL_FEATURES)
    ) + f" from model where {_SPLIT})")


def _scores(name):
    def build(spark, sf_dir):
        return _test_scores(spark, sf_dir, name).withColumn("learner", F.lit(M.LEARNERS[name]))
    return build


def _importance(spark, sf_dir):
    boosted, forest = (M.importances(m, spark) for m in _models(spark, sf_dir).values())
    return M.importance_table(boosted, forest)


def _fallback(spark, sf_dir):
    return X.global_importance(M.importances(_model(spark, sf_dir, "random_forest"), spark), top=3)


def _comparison(spark, sf_dir):
    """Both trained models on the test rows: confusion counts and quality measures."""
    _models(spark, sf_dir)
    boosted, forest = (_test_scores(spark, sf_dir, n) for n in _ESTIMATORS)
    return rounded(scoring.model_comparison(boosted.unionByName(forest)))


def _explained_rows(spark, sf_dir, name):
    """Every transaction with its score by a trained model and the exact explanation of it."""
    key = _key(spark, sf_dir, "dataset")
    if key not in _TRAINED:
        _TRAINED[key] = cut_lineage(model_dataset(clean_view(spark, sf_dir)))
    model = _model(spark, sf_dir, name)
    rows = vector_input(_TRAINED[key])
    scored = M.score(model, rows, name, keep=(S.TXN, S.TARGET, *[f"`{c}`" for c in S.MODEL_FEATURES]))
    found = T.add_attributions(scored, T.node_table(model, spark), S.MODEL_FEATURES)
    # At most one row a feature.
    weights = [(r["feature"], r["importance"]) for r in M.importances(model, spark).collect()]
    return T.add_explanation_record(found, S.MODEL_FEATURES, name, weights)


def _trained_explanations(spark, sf_dir):
    """Both trained models explained on every transaction; ``gap`` is what does not add up."""
    _models(spark, sf_dir)

    def shown(name):
        total = F.aggregate("attributions", F.lit(0.0), lambda a, v: a + v)
        e = F.col("explanation")
        return _explained_rows(spark, sf_dir, name).select(
            S.TXN, e["model_name"].alias("model_name"), e["available"].alias("available"),
            e["base_value"].alias("base_value"), "margin",
            (F.round(F.col("base_value") + total - F.col("margin"), 6) + 0.0).alias("gap"),
            e["top_risk_drivers"]["feature"].alias("risk_drivers"),
            e["top_mitigating_factors"]["feature"].alias("mitigating_factors"), e["key_reasons"].alias("key_reasons"))
    return rounded(shown("xgboost").unionByName(shown("random_forest")))


def _batch_scores(spark, sf_dir):
    """Every transaction scored by both models and its behaviour, with the explanation.

    One record per transaction and model: the contract of scoring one transaction, for all.
    """
    _models(spark, sf_dir)

    def scored(name):
        return _explained_rows(spark, sf_dir, name).select(
            S.TXN, S.TARGET, "model_name", "probability", "prediction", "explanation")

    found = D.detect(_detector_input(spark, sf_dir)).select(
        S.TXN, F.struct("behaviour_score", "behaviour_flags", "behaviour_reasons").alias("behavioural_analysis"))
    records = scored("xgboost").unionByName(scored("random_forest")).withColumn(
        "model_score", F.col("probability") * 100).join(found, S.TXN)
    return scoring.add_risk(records, "model_score", "behavioural_analysis.behaviour_score")


QUERIES: dict[str, Query] = {
    "H1_H2_location_anomaly": Query(_detector("location"), _detector_sql(
        "location", "moved_km, speed_kmh, coalesce(home_km,0e0) as home_km",
        "moved_km", "speed_kmh", "home_km")),
    "H3_H4_large_amount": Query(_detector("amount"), _detector_sql(
        "amount", "z_score, cast(past_rows as double) as history, avg_past as mean",
        "z_score", "mean", "history")),
    "H5_unusual_timing": Query(_detector("timing"), _detector_sql(
        "timing", "cast(hr as double) as hour, night_share", "hour", "night_share")),
    "H6_burst": Query(_detector("burst"), _detector_sql(
        "burst", "cast(n10 as double) as count_10m", "count_10m")),
    "H7_behaviour_score": Query(_combined, round_sql(with_txn(
        f"""select trans_num, {_BEST} as behaviour_score, {_FLAGS} as behaviour_flags,
        {_FLAGS} as reasons,
        case when location_score=95 then printf('Implausible travel: %.0f km at %.0f km/h',
            moved_km, speed_kmh)
          when location_score=50 then printf('Merchant is %.0f km from home', home_km)
          else '' end as location_reason,
        case when timing_score>0 then
          printf('Late-night transaction at %02d:00, unusual for this card', hr) else '' end
          as timing_reason,
        case when burst_score>0 then
          printf('%d earlier transactions within 10 minutes', n10) else '' end as burst_reason
        from scored""", H.HISTORY, _FOUND), "behaviour_score")),
    "X1_X2_X7_contributions": Query(_contributions, round_sql(with_txn(
        "select trans_num, rank, feature, label, shap_value, impact, magnitude from ranked",
        *_EXPLAINED), "shap_value", "magnitude")),
    "X1_feature_values": Query(_raw_values, with_txn(" union all ".join(
        f"select trans_num, '{c}' as feature, {_shown_sql(c)} as feature_value from input"
        for c in WEIGHTS), _EXPLAINED[0])),
    "X7_tree_contributions": Query(_stated_contributions, _stated_sql()),
    "X7_trained_explanations": Query(_trained_explanations),
    "X3_top_risk_drivers": Query(_top("top_risk_drivers"), _top_sql(">")),
    "X3_top_mitigating_factors": Query(_top("top_mitigating_factors"), _top_sql("<")),
    "X4_key_reasons": Query(_reasons, with_txn(
        f"""select trans_num, cast(rank-1 as int) as place,
          label||' contributed +'||cast(cast(round(cast(shap_value as decimal(18,4)),2)
            as decimal(18,2)) as varchar)||' toward fraud risk' as reason
        from (select trans_num, label, shap_value,
            row_number() over (partition by trans_num order by rank) as rank
          from ranked where shap_value>0) t where rank<=4
        union all select trans_num, 0, '{X.DEFAULT_REASON}' from ranked
        group by trans_num having max(shap_value)<=0""", *_EXPLAINED)),
    "X5_global_importance": Query(_fallback),
    "X6_feature_labels": Query(_labels, with_txn(
        """select feature, label, count(*) filter (where rank=1) as transactions from ranked
        group by feature, label""", *_EXPLAINED)),
    "M1_stratified_split": Query(_split, with_txn(
        f"select trans_num, is_fraud, case when {_SPLIT} then 'train' else 'test' end as part from txn")),
    "M2_class_weights": Query(_weights, round_sql(with_raw(
        """select is_fraud, count(*) as transactions,
          (select count(*) from raw)*1e0/((select count(distinct is_fraud) from raw)*count(*))
            as balanced_weight,
          case when is_fraud=1 then (select count(*) from raw where is_fraud=0)*1e0/count(*)
            else 1e0 end as positive_weight from raw group by is_fraud"""),
        "balanced_weight", "positive_weight")),
    "M3_standard_scaling": Query(_scaled, _SCALED_SQL),
    "M4_random_forest": Query(_scores("random_forest")),
    "M5_boosted_trees": Query(_scores("xgboost")),
    "M6_amount_rules": Query(_rules, _RULES_SQL),
    "M6_model_comparison": Query(_comparison),
    "M6_threshold_curve": Query(_curve, round_sql(
        with_raw("select * from curve", *_CURVE), "threshold", "precision", "recall", "false_positive_rate", "f1_score")),
    "M6_curve_summary": Query(_curve_summary, round_sql(
        with_raw(_CURVE_SUMMARY, *_CURVE), "roc_auc", "average_precision", "best_f1", "best_threshold")),
    "M6_trained_curves": Query(_trained_curves),
    "M7_feature_importance": Query(_importance),
    "M8_batch_scoring": Query(_batch_scores),
    "M9_M10_risk_scores": Query(_risk_scores, round_sql(with_txn(
        "select trans_num, risk_score, risk_category from rated", H.HISTORY, _FOUND, _RISK),
        "risk_score")),
    "M11_alerts": Query(_alerts, round_sql(with_txn(
        """select trans_num, epoch_us(trans_date_trans_time) as us, risk_score, risk_category
        from rated where risk_category in ('HIGH','CRITICAL')""",
        H.HISTORY, _FOUND, _RISK), "risk_score")),
    "M12_card_history": Query(_card, with_raw(
        """select trans_num, cc_num, epoch_us(trans_date_trans_time) as trans_date_trans_time,
        amt, category from raw where cc_num='4000000000000008'""")),
}

"""Splits, weights and quality measures of a scored label set.

Scores and ids are ranked by running totals over chunks of a histogram, never in one window over the
whole set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import at_ranks, running_totals
from tidemark.schemas import FEATURES
from tidemark.session import stage

TEST_SHARE = 0.2
SEED = 42


def stratified_split(labels: DataFrame, label: str = "churned", share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add `part`: the first `share` of each class by a hash of the id is test, the rest train.

    Copies of an id share its hash and therefore its part. A NULL label is a class and a NULL id an
    id, so every row comes back. The hash where each class is cut is selected by counting: ids below
    it are test, and no row is sorted or joined with more than the cut of its class.
    """
    key = F.md5(F.concat(F.coalesce(F.col("entity_id").cast("string"), F.lit("")), F.lit(f"-{seed}")))
    keyed = labels.withColumns({"_key": key, "_class": F.struct(F.col(label).alias("label"))})
    ids = keyed.groupBy("_class", "_key").agg(F.count(F.lit(1)).alias("_n"))
    # 13 hexadecimal digits, as many bits as a double holds exactly
    cut = at_ranks(ids, ["_class"], "_key", "_n", {"_cut": f"floor(total * {share}D)"}, position="conv(substring(_key, 1, 13), 16, 10)")
    test = F.col("_cut").isNull() | (F.col("_key") < F.col("_cut"))
    return keyed.join(F.broadcast(cut.select("_class", "_cut")), "_class").select(
        *labels.columns, F.when(test, "test").otherwise("train").alias("part")
    )


def class_weights(labels: DataFrame, label: str = "churned") -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    per_class = labels.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    # One row per class.
    totals = per_class.agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k"))
    return per_class.withColumn("_one", F.lit(1)).join(totals.withColumn("_one", F.lit(1)), "_one").select(
        label, "n_class", (F.col("n") / (F.col("k") * F.col("n_class"))).alias("weight")
    )


def _by_score(scored: DataFrame, label: str, score: str, groups: list[str]) -> DataFrame:
    counts = scored.groupBy(*groups, F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("n_neg"),
    )
    # A constant group keeps the call uniform; chunks cut it by score.
    return running_totals(
        counts.withColumn("_all", F.lit(0)), ["_all", *groups], "score", {"n_pos": "pos", "n_neg": "neg"}
    )


def _roc_auc():
    below = F.col("neg") - F.col("n_neg")
    # As doubles: the number of pairs outgrows bigint.
    pairs = F.sum(F.col("n_pos").cast("double") * (2 * below + F.col("n_neg")))
    return F.try_divide(pairs / F.lit(2.0), F.max("pos_all").cast("double") * F.max("neg_all")).alias("roc_auc")


def _average_precision():
    hits = F.col("pos_all") - F.col("pos") + F.col("n_pos")
    shown = hits + F.col("neg_all") - F.col("neg") + F.col("n_neg")
    return F.try_divide(F.sum(F.col("n_pos") * (hits / shown)), F.max("pos_all")).alias("average_precision")


def auc(scored: DataFrame, label: str = "churned", score: str = "score") -> DataFrame:
    """Area under the ROC curve: the share of (positive, negative) pairs in the right order,
    ties counting half. NULL where one of the classes is missing: there are no pairs."""
    ranked = _by_score(scored, label, score, [])
    return ranked.agg(_roc_auc(), F.max("pos_all").alias("n_positive"), F.max("neg_all").alias("n_negative"))


def average_precision(scored: DataFrame, label: str = "churned", score: str = "score") -> DataFrame:
    """Precision at each distinct threshold, weighted by the recall it adds; NULL without a positive."""
    return _by_score(scored, label, score, []).agg(_average_precision())


def evaluation(
    scored: DataFrame, groups: list[str], label: str = "churned", score: str = "score", threshold: float = 0.5
) -> DataFrame:
    """Per group: rows of each class, ROC AUC, average precision and F1, from one ranking of the scores.

    Every label other than 1, NULL too, counts as negative; a measure that a missing class leaves
    undefined is NULL, and F1 without anything guessed or true is 0.
    """
    ranked = _by_score(scored, label, score, groups)
    guessed = F.col("score") > threshold
    ranked = ranked.withColumns({"_tp": F.when(guessed, F.col("n_pos")).otherwise(0), "_fp": F.when(guessed, F.col("n_neg")).otherwise(0)})
    tp, fp, positive = F.sum("_tp"), F.sum("_fp"), F.max("pos_all")
    return ranked.groupBy(*groups).agg(
        positive.alias("n_positive"), F.max("neg_all").alias("n_negative"), _roc_auc(), _average_precision(),
        F.coalesce(F.try_divide(2.0 * tp, tp + fp + positive), F.lit(0.0)).alias("f1"),
    )


def f1_score(scored: DataFrame, label: str = "churned", score: str = "score", threshold: float = 0.5) -> DataFrame:
    guess = F.col(score) > threshold
    true = F.col(label) == 1
    matrix = scored.agg(
        F.count_if(guess & true).alias("tp"),
        F.count_if(guess & ~true).alias("fp"),
        F.count_if(~guess & true).alias("fn"),
        F.count_if(~guess & ~true).alias("tn"),
    )
    wrong = F.col("fp") + F.col("fn")
    return matrix.withColumn(
        "f1", F.when(F.col("tp") + wrong > 0, 2 * F.col("tp") / (2 * F.col("tp") + wrong)).otherwise(F.lit(0.0))
    )


def _vectors(df: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def fit_churn_model(train: DataFrame, label: str = "churned", rounds: int = 20, depth: int = 5, step: float = 0.05):
    """Boosted trees with balanced class weights on the 13 features.

    Rows without a label cannot be fitted and are refused; a set of one class is too.
    """
    from pyspark.ml.classification import GBTClassifier

    seen = train.agg(F.count_if(F.col(label).isNull()).alias("missing"), F.count_distinct(label).alias("classes")).first()
    if seen["missing"] or seen["classes"] < 2:
        raise ValueError(f"{seen['missing']} rows without a label and {seen['classes']} classes; two classes and no gaps are needed")

    # One row per class, so it may be broadcast; a shuffle by class would use two tasks.
    weights = F.broadcast(class_weights(train, label).select(label, "weight"))
    classifier = GBTClassifier(
        featuresCol="features", labelCol=label, weightCol="weight", maxIter=rounds, maxDepth=depth,
        stepSize=step, subsamplingRate=0.8, seed=SEED,
    )
    return classifier.fit(_vectors(train.join(weights, label)))


def score_churn(model, df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(_vectors(df))
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*df.columns, "score")


def feature_importances(model) -> dict[str, float]:
    return dict(zip(FEATURES, (float(v) for v in model.featureImportances.toArray())))


SCORES = "training_set string, entity_id bigint, label int, part string, score double"


def score_models(sets: dict[str, DataFrame], label: str = "churned", **fit) -> DataFrame:
    """Fit one model per training set on its train part and score its test part.

    Gives `SCORES` rows, written: the test rows with their scores and the train rows without. Rows with
    a NULL label take no part. A set whose train part has fewer than two classes is not fitted and
    its test rows have NULL scores, as nothing can be learned from it.
    """
    out = None
    for name, rows in sets.items():
        # read for the cut of the split and for its rows, with other columns each time
        labelled = stage(rows.where(F.col(label).isNotNull()), "labelled")
        split = stage(stratified_split(labelled, label), "split")
        train, test = (split.where(F.col("part") == part) for part in ("train", "test"))
        if train.agg(F.count_distinct(label)).first()[0] < 2:
            scored = test.withColumn("score", F.lit(None).cast("double"))
        else:
            scored = score_churn(fit_churn_model(train, label, **fit), test)
        mine = scored.unionByName(train.withColumn("score", F.lit(None).cast("double"))).select(
            F.lit(name).alias("training_set"), F.col("entity_id").cast("bigint"), F.col(label).cast("int").alias("label"), "part", "score"
        )
        out = mine if out is None else out.unionByName(mine)
    return stage(out, "model-scores")


def compare_models(scores: DataFrame) -> DataFrame:
    """Per training set of `score_models`: its numbers of rows and the quality of its model on the test part.

    Measures are NULL for a set that was not fitted.
    """
    test = F.col("part") == "test"
    sizes = scores.groupBy("training_set").agg(
        F.count_if(~test).alias("n_train"), F.count_if(test).alias("n_test"), F.count_if(test & (F.col("label") == 1)).alias("n_test_positive"),
        (F.count_if(F.col("score").isNotNull()) > 0).alias("fitted"),
    )
    figures = evaluation(scores.where(test & F.col("score").isNotNull()), ["training_set"], "label")
    # one row per training set on both sides
    return sizes.join(figures.drop("n_positive", "n_negative"), "training_set", "left")


def permuted(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """(feature_name, _row, value): each feature's values handed round among all rows, for every feature at once.

    Rows are numbered in the order of a hash of their number and once more, per feature, of their number and
    the feature; the row with a number in the one order gets the value of the row that has it in the
    other. `rows` has a number of its own in `_row`. Numbers come from running totals over chunks of
    the hash, so no feature's values meet in one task.
    """
    key = "md5(concat_ws('-', feature_name, string(_row), '{}'))"
    names = ", ".join(f"'{f}', {f}" for f in FEATURES)
    long = rows.selectExpr("_row", f"stack({len(FEATURES) + 1}, '', double(NULL), {names}) AS (feature_name, value)")
    keyed = long.withColumns({"_key": F.expr(key.format(seed)), "_one": F.lit(1)})
    numbered = running_totals(
        keyed, ["feature_name"], "_key", {"_one": "number"}, position="conv(substring(_key, 1, 13), 16, 10)"
    )
    takers = numbered.where("feature_name = ''").select("_row", "number")
    givers = numbered.where("feature_name <> ''").select("feature_name", "value", "number")
    return givers.join(takers, "number").select("feature_name", "_row", "value")


def permutation_importance(model, rows: DataFrame, label: str = "churned", seed: int = SEED) -> DataFrame:
    """(feature_name, roc_auc, importance): the AUC with the feature's values permuted, and how much it lost.

    All features are permuted and scored in one plan, 14 scored rows for each row. The permutation follows
    from the seed and the order in which the rows are written, so a rerun on a written table agrees.
    """
    numbered = stage(rows.withColumn("_row", F.monotonically_increasing_id()).select("_row", label, *FEATURES), "rows")
    given = permuted(numbered, seed)
    mixed = numbered.join(given, "_row").select(
        "feature_name", label, *[F.when(F.col("feature_name") == f, F.col("value")).otherwise(F.col(f)).alias(f) for f in FEATURES]
    )
    plain = numbered.select(F.lit("").alias("feature_name"), label, *FEATURES)
    figures = evaluation(score_churn(model, mixed.unionByName(plain)), ["feature_name"], label).select("feature_name", "roc_auc")
    base = figures.where("feature_name = ''").select(F.col("roc_auc").alias("_base"))
    return figures.where("feature_name <> ''").select(
        "feature_name", "roc_auc", (base.scalar() - F.col("roc_auc")).alias("importance")
    )

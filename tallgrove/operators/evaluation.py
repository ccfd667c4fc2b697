"""Confusion matrices, class statistics, ROC curves, AUC and model choice.

All functions take ``by``: tag rows by sample or model and one job evaluates
them side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrove.operators.ordering import ROWS_PER_BUCKET, running_totals


def positive_probability(score: Column, confidence: Column, positive: str) -> Column:
    """Probability of the positive class from predicted class and its confidence."""
    return F.when(score == positive, confidence).otherwise(1 - confidence)


def compare_with_observed(
    observed: DataFrame, predicted: DataFrame, id_column: str, label: str, predicted_id: str = "ID"
) -> DataFrame:
    """``(ID, ORIGINAL_LABEL, PREDICTED_LABEL, CONFIDENCE)`` for ids in both inputs."""
    truth = observed.select(F.col(id_column).alias("ID"), F.col(label).cast("string").alias("ORIGINAL_LABEL"))
    guess = predicted.select(
        F.col(predicted_id).alias("ID"), F.col("SCORE").alias("PREDICTED_LABEL"), "CONFIDENCE"
    )
    return truth.join(guess, "ID")


def confusion_matrix(
    df: DataFrame, actual: str = "ORIGINAL_LABEL", predicted: str = "PREDICTED_LABEL", by: tuple[str, ...] = ()
) -> DataFrame:
    """``(*by, ACTUAL_CLASS, PREDICTED_CLASS, COUNT)``, every pair of classes once.

    Rows collapse to one per cell on the map side; pairs that never occur are
    added to the (classes x classes) result with a count of zero.
    """
    cells = (
        df.groupBy(*by, F.col(actual).cast("string").alias("ACTUAL_CLASS"),
                   F.col(predicted).cast("string").alias("PREDICTED_CLASS"))
        .agg(F.count_if(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).alias("COUNT"))
        .filter(F.col("COUNT") > 0)
    )
    classes = F.array_distinct(F.flatten(F.collect_set(F.array("ACTUAL_CLASS", "PREDICTED_CLASS"))))
    empty = (
        cells.groupBy(*by).agg(classes.alias("c"))
        .select(*by, F.explode("c").alias("ACTUAL_CLASS"), "c")
        .select(*by, "ACTUAL_CLASS", F.explode("c").alias("PREDICTED_CLASS"), F.lit(0).cast("bigint").alias("COUNT"))
    )
    return (
        cells.unionByName(empty)
        .groupBy(*by, "ACTUAL_CLASS", "PREDICTED_CLASS")
        .agg(F.sum("COUNT").alias("COUNT"))
    )


def class_stats(matrix: DataFrame, beta: float = 1.0, by: tuple[str, ...] = ()) -> DataFrame:
    """Per class: precision, recall, F-beta, support; plus accuracy and Cohen's kappa.

    0/0 is NULL throughout. ``matrix`` is the small output of ``confusion_matrix``.
    """
    n = F.col("COUNT")
    hit = F.when(F.col("ACTUAL_CLASS") == F.col("PREDICTED_CLASS"), n).otherwise(0)
    sides = matrix.select(*by, F.inline(F.array(
        F.struct(F.col("ACTUAL_CLASS").alias("CLASS"), n.alias("SUPPORT"),
                 F.lit(0).cast("bigint").alias("PREDICTED"), hit.cast("bigint").alias("HITS")),
        F.struct(F.col("PREDICTED_CLASS").alias("CLASS"), F.lit(0).cast("bigint").alias("SUPPORT"),
                 n.alias("PREDICTED"), F.lit(0).cast("bigint").alias("HITS")),
    )))
    per_class = sides.groupBy(*by, "CLASS").agg(*[F.sum(c).alias(c) for c in ("SUPPORT", "PREDICTED", "HITS")])
    all_classes = Window.partitionBy(*by)
    total = F.sum("SUPPORT").over(all_classes)
    agree = F.sum("HITS").over(all_classes) / total
    chance = F.sum(F.col("SUPPORT").cast("double") * F.col("PREDICTED")).over(all_classes) / (
        total.cast("double") * total
    )
    precision = F.try_divide(F.col("HITS"), F.col("PREDICTED"))
    recall = F.try_divide(F.col("HITS"), F.col("SUPPORT"))
    square = beta * beta
    f_beta = F.try_divide(
        F.lit(1 + square) * F.col("HITS"),
        F.lit(1 + square) * F.col("HITS")
        + F.lit(square) * (F.col("SUPPORT") - F.col("HITS"))
        + (F.col("PREDICTED") - F.col("HITS")),
    )
    return per_class.select(
        *by,
        "CLASS",
        precision.alias("PRECISION"),
        recall.alias("RECALL"),
        F.when(precision.isNotNull() & recall.isNotNull(), f_beta).alias("FBETA"),
        "SUPPORT",
        agree.alias("ACCURACY"),
        F.try_divide(agree - chance, 1 - chance).alias("KAPPA"),
    )


def _score_groups(
    df: DataFrame, actual: str, prob: str, positive: str, by: tuple[str, ...], rows_per_bucket: int
) -> DataFrame:
    """One row per distinct score with positives, negatives and their running sums."""
    is_positive = F.col(actual).cast("string") == positive
    known = F.col(actual).isNotNull() & F.col(prob).isNotNull()
    # Unknown scores are dropped as one group: a filter on the score would be
    # moved below it and compute every score twice.
    grouped = (
        df.groupBy(*by, F.col(prob).alias("_score"))
        .agg(F.count_if(known & is_positive).alias("p"), F.count_if(known & ~is_positive).alias("n"))
        .filter(F.col("p") + F.col("n") > 0)
    )
    return running_totals(grouped, list(by), "_score", ["p", "n"], rows_per_bucket)


def auc(
    df: DataFrame,
    actual: str = "ORIGINAL_LABEL",
    prob: str = "PROBABILITY",
    positive: str = "1",
    by: tuple[str, ...] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``(*by, STAT_NAME, STAT_VALUE)``: the exact area, tied scores counted half.

    NULL if a group has no positives or no negatives.
    """
    return area(_score_groups(df, actual, prob, positive, by, rows_per_bucket), by)


def area(groups: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The area from one row per distinct score: every negative counts the
    positives above it, and half of those that share its score."""
    pairs = F.sum(F.col("n").cast("double") * (F.col("p_before") + F.col("p") / 2))
    value = F.try_divide(pairs, F.max("p_all").cast("double") * F.max("n_all"))
    return groups.groupBy(*by).agg(value.alias("STAT_VALUE")).select(*by, F.lit("AUC").alias("STAT_NAME"), "STAT_VALUE")


def roc_curve(
    df: DataFrame,
    actual: str = "ORIGINAL_LABEL",
    prob: str = "PROBABILITY",
    positive: str = "1",
    by: tuple[str, ...] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``(*by, ID, FPR, TPR)``: the origin as ID 0, then one point per distinct score."""
    groups = _score_groups(df, actual, prob, positive, by, rows_per_bucket)
    point = F.struct(
        F.col("position").alias("ID"),
        F.try_divide(F.col("n_before") + F.col("n"), F.col("n_all")).alias("FPR"),
        F.try_divide(F.col("p_before") + F.col("p"), F.col("p_all")).alias("TPR"),
    )
    origin = F.struct(
        F.lit(0).cast("bigint").alias("ID"),
        F.when(F.col("n_all") > 0, 0.0).alias("FPR"),
        F.when(F.col("p_all") > 0, 0.0).alias("TPR"),
    )
    # The top score brings the origin along, so no second read is needed.
    return groups.select(*by, F.inline(
        F.when(F.col("position") == 1, F.array(origin, point)).otherwise(F.array(point))
    ))


def single_value(df: DataFrame, column: str):
    """The only value of a one-row relation."""
    rows = df.select(column).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one row for {column}, found {len(rows)}")
    return rows[0][0]


def select_champion(first: float | None, second: float | None) -> str:
    """'a' if the first area is strictly larger, else 'b'; an unknown area never wins."""
    if first is None:
        return "b"
    return "a" if second is None or first > second else "b"

"""Area under the ROC curve from ranks, of any number of models at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.operators.prefix_sums import running_totals


def rank_auc(
    scored: DataFrame, label: str = "isFraud", score: str = "score", model: str = "model"
) -> DataFrame:
    """(model, positives, negatives, auc): exact, ties count half; one row per model.

    A scan counts labels per distinct score, map-side first. Over these counts, range-sorted,
    running totals say how many negatives lie below each score; a positive beats those and half
    of the negatives at its own score. Sums are whole numbers, so the order of rows changes
    nothing. NaN is the greatest score; rows without a score or a label are left out. A model
    with one class only has no area: NULL.
    """
    known = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    positive = F.col(label) == 1
    counts = known.groupBy(model, (F.col(score) + F.lit(0.0)).alias(score)).agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    ranked = running_totals(counts, ["negatives"], [score], [model])
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("positives", "negatives", "negatives_before")}
    halves = wide["positives"] * (2 * wide["negatives_before"] + wide["negatives"])
    sums = ranked.groupBy(model).agg(
        F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"),
        F.sum(halves.cast("decimal(38,0)")).alias("halves"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return sums.select(
        model, "positives", "negatives",
        F.when(pairs > 0, F.col("halves").cast("double") / (2 * pairs)).alias("auc"),
    )

"""Histograms over whole columns, in two passes however many there are.

The first pass finds each value range (one aggregate, read as a scalar subquery); the
second assigns bins and counts them with map-side combine. Bins follow numpy's rule:
equal widths over [min, max], left-closed, the last one closed on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.functions.numeric import is_number
from payrisk.schema import TAIL_PROBABILITY

PROBABILITY_BINS = 40
TAIL_BINS = 30
SCORE_BINS = 40
AMOUNT_LOG_BINS = 59


@dataclass(frozen=True)
class Bins:
    """What to bin (NULL: leave the row out), into how many bins.

    ``low`` and ``high`` are aggregates; by default the smallest and largest value.
    """

    value: Column
    count: int
    low: Column | None = None
    high: Column | None = None


def _range_of(value: Column, spec: Bins) -> Column:
    low = F.coalesce(spec.low if spec.low is not None else F.min(value), F.lit(0.0))
    high = F.coalesce(spec.high if spec.high is not None else F.max(value), F.lit(1.0))
    pad = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    return F.struct((low - pad).alias("low"), (high + pad).alias("high"))


def _edge(position: Column, span: Column, count: Column) -> Column:
    """Edge at a position; the last edge is the upper end itself, free of rounding."""
    step = (span["high"] - span["low"]) / count.cast("double")
    inner = position.cast("double") * step + span["low"]
    return F.when(position == count, span["high"]).otherwise(inner)


def _assign_bins(values: DataFrame, ranges: Column, counts: dict[str, int]) -> DataFrame:
    """Replace each value column by its bin; NULL stays NULL.

    One projection per step: what a step computes is then evaluated once, not once per use.
    The quotient may be one off beside an edge, so the edges decide.
    """
    names = list(counts)
    spans = values.select(*names, ranges.alias("__ranges"))
    for n in names:
        low, high = F.col("__ranges")[n]["low"], F.col("__ranges")[n]["high"]
        quotient = (F.col(n) - low) / (high - low) * float(counts[n])
        spans = spans.withColumns(
            {
                f"{n}__low": low,
                f"{n}__step": (high - low) / float(counts[n]),
                f"{n}__guess": F.least(F.floor(quotient), F.lit(counts[n] - 1)).cast("int"),
            }
        )

    def placed(n: str) -> Column:
        value, guess = F.col(n), F.col(f"{n}__guess")
        low, step = F.col(f"{n}__low"), F.col(f"{n}__step")
        below = value < guess * step + low
        above = (guess < counts[n] - 1) & (value >= (guess + 1) * step + low)
        return guess - below.cast("int") + above.cast("int")

    return spans.select(*[placed(n).alias(n) for n in names])


def histograms(df: DataFrame, specs: dict[str, Bins]) -> DataFrame:
    """Columns ``histogram, bin, lower, upper, count``: every bin of every histogram."""
    names = list(specs)
    raw = df.withColumns({f"__value_{i}": specs[n].value for i, n in enumerate(names)})
    value_of = {n: F.col(f"__value_{i}") for i, n in enumerate(names)}
    finite = {n: F.when(is_number(value_of[n]), value_of[n]) for n in names}
    ranges = raw.agg(
        F.struct(*[_range_of(finite[n], specs[n]).alias(n) for n in names])
    ).scalar()
    values = raw.select(*[finite[n].alias(n) for n in names])
    bins = _assign_bins(values, ranges, {n: specs[n].count for n in names})
    # Bins are columns by now: a generator would evaluate shared expressions every time.
    cell = [F.struct(F.lit(n).alias("histogram"), F.col(n).alias("bin")) for n in names]
    cells = bins.select(F.inline(F.array(*cell)))
    counted = (
        cells.filter(F.col("bin").isNotNull())
        .groupBy("histogram", "bin")
        .agg(F.count("*").alias("count"))
    )
    per_histogram = F.array(
        *[
            F.struct(
                F.lit(n).alias("histogram"),
                F.lit(specs[n].count).alias("bins"),
                F.col("__ranges")[n].alias("span"),
            )
            for n in names
        ]
    )
    one_row = df.sparkSession.range(1).select(ranges.alias("__ranges"))
    every_bin = one_row.select(F.inline(per_histogram)).select(
        "histogram", "bins", "span", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin")
    )
    return every_bin.join(counted, ["histogram", "bin"], "left").select(
        "histogram",
        "bin",
        _edge(F.col("bin"), F.col("span"), F.col("bins")).alias("lower"),
        _edge(F.col("bin") + 1, F.col("span"), F.col("bins")).alias("upper"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    )


def _centred(df: DataFrame) -> DataFrame:
    center = (F.col("lower") + F.col("upper")) / F.lit(2.0)
    return df.select("bin", center.alias("center"), "count").orderBy("bin")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Columns ``bin, center, count`` for one numeric column."""
    return _centred(histograms(df, {"value": Bins(F.col(column), bins)}))


def probability_histogram(df: DataFrame, bins: int = PROBABILITY_BINS) -> DataFrame:
    return histogram(df, "fraud_probability", bins)


def risk_score_histogram(df: DataFrame, bins: int = SCORE_BINS) -> DataFrame:
    return histogram(df, "risk_score", bins)


def tail_probability(df: DataFrame) -> Column:
    """Probability where it exceeds 0.3, or exceeds its mean if none does; else NULL."""
    p = F.nanvl(F.col("fraud_probability"), F.lit(None).cast("double"))
    fixed = F.lit(TAIL_PROBABILITY)
    start = df.agg(F.when(F.count_if(p > fixed) > 0, fixed).otherwise(F.avg(p))).scalar()
    return F.when(p > start, p)


def tail_histogram(df: DataFrame, bins: int = TAIL_BINS) -> DataFrame:
    return _centred(histograms(df, {"tail": Bins(tail_probability(df), bins)}))


def _log_amount_bins(prediction: int, bins: int) -> Bins:
    """Bins over log10(amount) from 0 (amounts below 1 count as 1) to the largest amount."""
    amount = F.when(is_number(F.col("amount")), F.col("amount"))
    top = F.greatest(F.coalesce(F.max(amount), F.lit(10.0)), F.lit(10.0))
    counted = (F.col("prediction") == prediction) & amount.isNotNull()
    return Bins(
        F.when(counted, F.log10(F.greatest(amount, F.lit(1.0)))),
        bins,
        low=F.lit(0.0),
        high=F.log10(top),
    )


def amount_log_histogram(df: DataFrame, bins: int = AMOUNT_LOG_BINS) -> DataFrame:
    """Amounts by predicted class in log-spaced bins; edges are given as amounts."""
    names = {"0": 0, "1": 1}
    both = histograms(df, {name: _log_amount_bins(c, bins) for name, c in names.items()})
    ten = F.lit(10.0)
    return both.select(
        F.col("histogram").cast("double").alias("prediction"),
        "bin",
        F.pow(ten, F.col("lower")).alias("lower"),
        F.pow(ten, F.col("upper")).alias("upper"),
        "count",
    ).orderBy("prediction", "bin")


def distributions(df: DataFrame) -> DataFrame:
    """All the reported distributions of a scored table at once, sharing both passes.

    Amount edges are powers of ten here: ``lower`` and ``upper`` hold the exponents.
    """
    return histograms(
        df,
        {
            "fraud_probability": Bins(F.col("fraud_probability"), PROBABILITY_BINS),
            "fraud_probability_tail": Bins(tail_probability(df), TAIL_BINS),
            "risk_score": Bins(F.col("risk_score"), SCORE_BINS),
            "log10_amount_not_fraud": _log_amount_bins(0, AMOUNT_LOG_BINS),
            "log10_amount_fraud": _log_amount_bins(1, AMOUNT_LOG_BINS),
        },
    )

"""Quality rules: counted statistics, fixed base rules, and robust multivariate outliers.

Statistics are counted by a map over the documents. Per language and source, a minimum
covariance determinant estimate of their centre and scatter is then fitted: from two starts,
concentration steps keep the part of the group that lies nearest and estimate again from that
part alone; of the two estimates the one of the smaller determinant is taken. Each step is one
aggregate over the small table of statistics, by group and distance bin, so a hot group is
summed map-side and never meets in one task. Every group's estimate is drawn towards that of
all documents as if ``PRIOR`` of these were in it: a small group follows them, a large one
itself, by one rule at every size. Documents far from their group by Mahalanobis distance are
rejected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.llm.common import SPACES, let, narrowed, stored, text_or_empty, words_of

# The base rules.
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

STATS = ("x_length", "x_word", "x_symbol", "x_line", "x_repeat")
# Units of the first distances, before a scatter is known.
START_SD = (0.5, 0.05, 0.10, 0.20, 0.10)
# Least standard deviation of each statistic, well below what groups show where they vary.
# Most groups hold hardly a symbol, double line or repeat in their nearest part: there these
# alone say how much of it is a trace.
LEAST_SD = (0.1, 0.02, 0.05, 0.10, 0.10)
KEEP_PART = 0.75  # share of a group that the estimate is concentrated on
STEPS = 4
PRIOR = 20  # documents of all groups that count as members of each
CONSISTENCY = 1.41  # widens the scatter of the nearest 75 % to that of a normal sample
CUT = 20.515  # squared distance; the chi-square quantile 0.999 of 5 dimensions
BINS_PER_DOUBLING = 16
GROUP, ALL = "__quality_group", "__quality_all"


def n_words() -> Column:
    return F.regexp_count(text_or_empty(), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def word_chars() -> Column:
    return F.length(F.translate(text_or_empty(), SPACES, "")).cast("bigint")


def n_symbols() -> Column:
    text = text_or_empty()
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint")


def n_dup_lines() -> Column:
    lines = F.filter(F.split(text_or_empty(), "\n"), lambda x: F.translate(x, SPACES, "") != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def window_hashes(words: Column) -> Column:
    """64-bit hashes of all five-word windows, by position; empty with fewer words."""
    def joined(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

    def tail(values: Column, k: int) -> Column:
        return F.slice(values, k + 1, F.greatest(F.size(values) - k, F.lit(0)))

    def of_hashes(h: Column) -> Column:
        return let(
            joined(h, tail(h, 1)),
            lambda two: let(
                joined(two, tail(two, 2)),
                lambda four: F.slice(
                    joined(four, tail(h, 4)), 1, F.greatest(F.size(h) - WINDOW + 1, F.lit(0))
                ),
            ),
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def _covered(hashes: Column) -> Column:
    """Words in windows that occur more than once.

    Sorting (hash, position) puts equal windows side by side. The repeated positions, sorted
    again, cover five words each, less where they overlap.
    """
    entries = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(e: Column) -> Column:
        n = F.size(e)
        keys = F.transform(e, lambda x: x["h"])
        before = F.concat(F.array(F.lit(None).cast("bigint")), F.slice(keys, 1, n - 1))
        after = F.concat(F.slice(keys, 2, n), F.array(F.lit(None).cast("bigint")))
        sides = F.arrays_zip(e.alias("e"), before.alias("b"), after.alias("a"))
        hit = F.filter(
            sides,
            lambda s: F.coalesce(s["e"]["h"] == s["b"], F.lit(False))
            | F.coalesce(s["e"]["h"] == s["a"], F.lit(False)),
        )
        return F.sort_array(F.transform(hit, lambda s: s["e"]["i"]))

    def total(places: Column) -> Column:
        gaps = F.zip_with(
            places, F.slice(places, 2, F.size(places)), lambda a, b: F.least(F.lit(WINDOW), b - a)
        )
        return F.aggregate(gaps, F.lit(0), lambda acc, g: acc + F.coalesce(g, F.lit(WINDOW)))

    return let(entries, lambda e: let(repeated(e), total))


def n_repeat_words() -> Column:
    """Words in five-word windows found twice or more; the search runs only if there are any."""
    return let(
        window_hashes(words_of(text_or_empty())),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)),
    ).cast("bigint")


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` plus the counted statistics and ``base_failed``; null texts count as empty."""
    counted = docs.withColumns(
        {
            "n_words": n_words(),
            "word_chars": word_chars(),
            "n_symbols": n_symbols(),
            "n_dup_lines": n_dup_lines(),
            "n_repeat_words": n_repeat_words(),
        }
    )
    few = F.col("n_words") < MIN_WORDS
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")
    return counted.withColumn("base_failed", few | repeated)


def _vector() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "x_length": F.log1p(F.col("n_words").cast("double")),
        "x_word": F.log1p(F.col("word_chars") / words),
        "x_symbol": F.log1p(F.col("n_symbols") / words),
        "x_line": F.log1p(F.col("n_dup_lines").cast("double")) / F.log1p(words),
        "x_repeat": F.sqrt(F.col("n_repeat_words") / words),
    }


def _moments() -> list[Column]:
    p = range(len(STATS))
    return [
        F.count("*").alias("n"),
        *[F.sum(STATS[i]).alias(f"s{i}") for i in p],
        *[F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"q{i}{j}") for i in p for j in p if j <= i],
    ]


def _summed(rows: DataFrame, by: list[str]) -> DataFrame:
    names = [c for c in rows.columns if c == "n" or c[0] in "sq" and c[1:].isdigit()]
    return rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in names])


def _factor(moments: DataFrame, by: list[str]) -> DataFrame:
    """Centre m_i and the inverse Cholesky factor's recurrence l_ij of the covariance.

    Column arithmetic on one row per group: L L^T = covariance, with the least variances added
    to its diagonal, which keeps every group's matrix regular.
    """
    p = range(len(STATS))
    out = moments.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in p})
    for i in p:
        for j in range(i + 1):
            value = F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + F.lit(LEAST_SD[i] ** 2)
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(value, F.lit(1e-9))) if i == j else value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    return out.select(*by, "n", *[f"m{i}" for i in p], *[f"l{i}{j}" for i in p for j in range(i + 1)])


def _with_prior(moments: DataFrame, prior: DataFrame | None) -> DataFrame:
    """The sums of each group and of ``PRIOR`` more documents that are like all of them."""
    if prior is None:
        return moments
    sums = [c for c in moments.columns if c[0] in "sq" and c[1:].isdigit()]
    typical = prior.select(*[(F.col(c) / F.col("n") * PRIOR).alias(f"p_{c}") for c in sums])
    more = {c: F.col(c) + F.col(f"p_{c}") for c in sums}
    joined = moments.join(F.broadcast(typical)).withColumns({**more, "n": F.col("n") + F.lit(PRIOR)})  # one row
    return joined.select(*moments.columns)


def _with_distance(rows: DataFrame, fit: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Rows with ``d2``, the squared Mahalanobis distance |L^-1 (x - m)|^2 in their group.

    One coordinate of the forward substitution per projection, each named once it is solved.
    """
    p = range(len(STATS))
    out = rows.join(fit.drop("n"), by, how)
    for i in p:
        value = F.col(STATS[i]) - F.col(f"m{i}")
        for j in range(i):
            value = value - F.col(f"l{i}{j}") * F.col(f"y{j}")
        out = out.withColumn(f"y{i}", value / F.col(f"l{i}{i}"))
    total = F.lit(0.0)
    for i in p:
        total = total + F.col(f"y{i}") * F.col(f"y{i}")
    return out.select(*rows.columns, total.alias("d2"))


def _nearest(rows: DataFrame, fit: DataFrame, by: list[str]) -> DataFrame:
    """Sums over the nearest part of each group, found by distance bins."""
    bin_no = F.floor(F.log2(F.col("d2") + 1e-6) * BINS_PER_DOUBLING)
    binned = _with_distance(rows, fit, by).groupBy(*by, bin_no.alias("bin")).agg(*_moments())
    binned = stored(binned, "mcd-bins")  # merged by group and bin before a group meets in one task
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("bin"))
    whole = F.sum("n").over(Window.partitionBy(*by))
    near = binned.withColumn("upto", upto).withColumn("whole", whole)
    kept = near.filter(F.col("upto") - F.col("n") < KEEP_PART * F.col("whole"))
    return _summed(kept.drop("upto", "whole"), by)


def _starts(rows: DataFrame, by: list[str]) -> list[DataFrame]:
    """Two first fits: around the means and around the medians, in fixed units, a scatter that
    outliers cannot widen."""
    p = range(len(STATS))
    units = {f"l{i}{j}": F.lit(START_SD[i] if i == j else 0.0) for i in p for j in range(i + 1)}
    count = F.count("*").alias("n")
    means = rows.groupBy(*by).agg(count, *[F.avg(c).alias(f"m{i}") for i, c in enumerate(STATS)])
    medians = rows.groupBy(*by).agg(
        count, *[F.percentile_approx(c, 0.5, 1000).alias(f"m{i}") for i, c in enumerate(STATS)]
    )
    return [df.withColumns(units) for df in (means, medians)]


def mcd(rows: DataFrame, by: list[str], groups: int, prior: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(fit, sums of the nearest part) per group: of both starts, after ``STEPS`` concentration
    steps each, the one with the smaller determinant.

    ``groups`` is how many there are: fits of so few rows are kept in few files, so that they
    are sent to the rows and not the rows to them.
    """
    found = []
    for start in _starts(rows, by):
        fit = stored(narrowed(start, groups), "mcd-start")
        for _ in range(STEPS):
            sums = stored(narrowed(_nearest(rows, fit, by), groups), "mcd-sums")
            fit = stored(narrowed(_factor(_with_prior(sums, prior), by), groups), "mcd")
        found.append(fit.join(sums.select(*by, *[F.col(c).alias(f"near_{c}") for c in sums.columns if c not in by]), by))
    volume = reduce(lambda a, b: a * b, [F.col(f"l{i}{i}") for i in range(len(STATS))])
    names = [c for c in found[0].columns if c not in by]
    best = found[0].unionByName(found[1]).groupBy(*by).agg(F.min_by(F.struct(*names), volume).alias("best"))
    best = stored(narrowed(best.select(*by, "best.*"), groups), "mcd-best")
    own = [c for c in names if not c.startswith("near_")]
    return best.select(*by, *own), best.select(*by, *[F.col(c).alias(c[5:]) for c in names if c not in own])


def _group(lang: str = "lang", source: str = "source") -> Column:
    """One key for language and source in which null differs from every text."""
    part = [
        F.when(F.col(c).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(c)))
        for c in (lang, source)
    ]
    return F.concat(F.length(part[0]).cast("string"), F.lit(":"), part[0], part[1])


ADDED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "distance2", "kept", GROUP, "d2", *STATS,
)


def judge(docs: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus the statistics, ``base_failed``, ``distance2`` and ``kept``.

    A document is kept if the base rules pass and its squared distance from its language and
    source is within ``CUT``. Null languages and sources are groups of their own; a group of
    which no document passes the base rules has no estimate, and these alone decide. Only
    documents that pass the base rules are estimated from. An empty table stays empty; repeated
    rows are judged alike; columns of the added names are replaced. Columns named in
    ``without`` are dropped once they are counted.
    """
    counted = statistics(docs).drop(*without).withColumns(_vector() | {GROUP: _group()})
    counted = stored(counted, "quality")
    good = counted.filter(~F.col("base_failed")).select(GROUP, F.lit(1).alias(ALL), *STATS)
    groups = good.select(GROUP).distinct().count()
    _, prior = mcd(good, [ALL], 1)
    fits, _ = mcd(good, [GROUP], groups, prior)
    judged = _with_distance(counted, fits, [GROUP], "left")
    distance = F.col("d2") / CONSISTENCY
    near = F.coalesce(distance <= CUT, F.lit(True))
    return (
        judged.withColumn("distance2", distance)
        .withColumn("kept", ~F.col("base_failed") & near)
        .drop(GROUP, "d2", *STATS)
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns, also those named like a statistic."""
    own = {c: f"__own_{c}" for c in docs.columns if c in ADDED}
    judged = judge(docs.withColumnsRenamed(own)).filter("kept")
    return judged.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def quality_table(docs: DataFrame) -> DataFrame:
    judged = judge(docs.select("doc_id", "text", "lang", "source"), without=("text",))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance2",
    )

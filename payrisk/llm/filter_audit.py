"""Filter interaction audit: what every order of five filters removes, and which filter is to blame.

Each document is one bit mask of the filters that it fails. A source's documents are then at
most 32 mask cells, summed map-side, whatever their number. A recursive query extends filter
prefixes by the letters not used yet: it joins a source's cells, carries the bits applied so
far, and every level emits the counts of its step. All orders together are 325 prefixes a
source; a prefix that many orders share is worked out once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.llm.common import let, stored, table, text_or_empty, words_of

# The filters' letters, in the order of their bits, and their limits.
FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT_PCT = 65
MOST_CAPITALS_PCT = 5
SYMBOLS = "[#$%&*|]"
COPY_BIT = 1 << FILTERS.index("E")

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

LETTERS = "array({})".format(
    ", ".join(f"named_struct('letter', '{c}', 'bit', {1 << i})" for i, c in enumerate(FILTERS))
)

# Every level of the recursion is one step: ``bit`` is the step's filter, ``applied`` are those
# before it. LIMIT ALL lifts the row limit of recursive queries, as sources may be many.
WALK = """
WITH RECURSIVE walk(part, prefix, applied, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
  SELECT part, '', 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM {cells}
  UNION ALL
  SELECT w.part, concat(w.prefix, w.next.letter), w.applied | w.next.bit, w.step + 1,
    aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & (w.applied | w.next.bit) = 0, x.n, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & w.applied = 0 AND x.mask & w.next.bit != 0, x.n, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & w.applied != 0 AND x.mask & w.next.bit != 0, x.n, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask = w.next.bit, x.n, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & w.applied = 0 AND x.mask & w.next.bit != 0, x.good, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + IF(x.mask & w.applied = 0 AND x.mask & w.next.bit != 0, x.toxic, 0L))
  FROM (
    SELECT part, prefix, applied, step,
      explode(filter(letters, f -> f.bit & applied = 0)) AS next
    FROM (SELECT *, {letters} AS letters FROM walk)
  ) w JOIN {cells} c ON c.part = w.part
)
SELECT * FROM (SELECT * FROM walk LIMIT ALL) WHERE step > 0
""".replace("{letters}", LETTERS)


def failures() -> Column:
    """Bits of the filters A to D that a text fails; null texts count as empty."""
    text = text_or_empty()

    def of_words(words: Column) -> Column:
        n, distinct = F.size(words).cast("bigint"), F.size(F.array_distinct(words)).cast("bigint")
        few = F.when(n < LEAST_WORDS, 1).otherwise(0)
        return few + F.when(100 * distinct < LEAST_DISTINCT_PCT * n, 2).otherwise(0)

    length = F.length(text).cast("bigint")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("bigint")
    return (
        let(words_of(text), of_words)
        + F.when(100 * capitals > MOST_CAPITALS_PCT * length, 4).otherwise(0)
        + F.when(text.rlike(SYMBOLS), 8).otherwise(0)
    )


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per source and set of failed filters.

    Copies are found by digest. Rows are combined by (digest, source, mask, labels) first, each
    with its least id and how often that id occurs, so that a text copied a million times is a
    few rows when the copies of one text meet.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        failures().alias("mask"),
        F.unhex(F.sha2(text_or_empty().cast("binary"), 256)).alias("digest"),
    )
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    marked = rows.join(marks.filter("doc_id IS NOT NULL"), "doc_id", "left").select(
        "doc_id", "digest", "part", "mask",
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )
    key = ["digest", "part", "mask", "good", "toxic"]
    once = marked.groupBy("doc_id", *key).agg(F.count("*").alias("n"))
    named = F.col("doc_id").isNotNull()
    groups = once.groupBy(*key).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(named, F.col("n")).otherwise(0)).alias("named"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("least"),
    )
    groups = stored(groups, "copy-groups")
    firsts = groups.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    is_first = F.coalesce(F.col("least.doc_id") == F.col("first"), F.lit(False))
    copies = F.col("named") - F.when(is_first, F.col("least.n")).otherwise(0)
    split = groups.join(firsts, "digest").select(
        "part", "good", "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask").alias("mask"), (F.col("n") - copies).alias("n")),
                F.struct((F.col("mask") + COPY_BIT).alias("mask"), copies.alias("n")),
            )
        ),
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("good") * F.col("n")).alias("good"),
        F.sum(F.col("toxic") * F.col("n")).alias("toxic"),
    )


def prefix_steps(cells: DataFrame) -> DataFrame:
    """(part, prefix, step, ...): the counts of each prefix's last filter, of every source."""
    by_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.sparkSession.sql(WALK, cells=stored(by_part, "mask-cells"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step with the counts of ``COUNTS`` and shapley.

    Null texts count as empty, null sources as "". Labels that are missing, null or repeated
    count as 1 if any row says so. A document fails E if a smaller id has its text; documents
    without an id never do, nor do repeated rows of the smallest id. An empty table gives no
    part and so no row. Columns other than doc_id, text and source (quality and toxic of the
    labels) are not read.
    """
    walk = stored(prefix_steps(mask_cells(docs, labels)), "prefix-steps")
    letter = F.substring("prefix", -1, 1).alias("letter")
    # Of the orders, (5 - step)! go on from a prefix: each repeats its last filter's removals.
    weight = F.factorial(F.lit(len(FILTERS)) - F.col("step"))
    blame = walk.groupBy("part", letter).agg(F.sum(F.col("removed") * weight).alias("shapley"))
    orders = walk.filter(F.col("step") == len(FILTERS)).select(
        "part", F.col("prefix").alias("filter_order"),
        F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"),
    )
    at_step = orders.withColumns(
        {
            "prefix": F.col("filter_order").substr(F.lit(1), F.col("step")),
            "letter": F.col("filter_order").substr(F.col("step"), F.lit(1)),
        }
    )
    return (
        at_step.join(walk.drop("step", "applied"), ["part", "prefix"])
        .join(blame, ["part", "letter"])
        .select("part", "filter_order", "step", *COUNTS, "shapley")
    )


def audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), masks AS (
  SELECT x.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
    CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN x.doc_id > min(x.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM texts x LEFT JOIN marks m ON x.doc_id = m.doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask
), letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
prefixes(prefix, before, letter, bit, step) AS (
  SELECT letter, 0, letter, bit, 1 FROM letters
  UNION ALL
  SELECT prefix || l.letter, before | p.bit, l.letter, l.bit, step + 1
  FROM prefixes p JOIN letters l ON ((p.before | p.bit) & l.bit) = 0
), steps AS (
  SELECT part, prefix, any_value(letter) AS letter, any_value(step) AS step,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit != 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before != 0 AND mask & bit != 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit != 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit != 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells CROSS JOIN prefixes GROUP BY part, prefix
), counts AS (
  SELECT o.part, o.prefix AS filter_order, s.step, s.letter, s.kept, s.removed, s.redundant,
    s.unique_fails, s.good_lost, s.toxic_lost
  FROM steps o JOIN steps s ON s.part = o.part AND starts_with(o.prefix, s.prefix) WHERE o.step = 5
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counts
"""

"""Mixing sources to target weights.

Every document gets a hash-random key. Keys are cut into 4096 ranges per source; prefix sums
of the ranges' token counts name the one range where a source's budget runs out, and only the
rows of that range are summed one by one. What results is one row per source: whole epochs,
the key at the cut, and the words left for it. Applying it is a map over the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.llm.common import stored, text_or_empty

# Weights by rank of the source, share of all words, most repeats of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
KEY_DIGITS = 3  # hexadecimal digits of a range: 4096 ranges


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_key(column: str = "source") -> Column:
    """The source as a key that holds null too, in order of code points, null last."""
    return F.concat(
        F.when(F.col(column).isNull(), "1").otherwise("0"), F.coalesce(F.col(column), F.lit(""))
    )


def random_key() -> Column:
    """The document's place in the order of its source: a hash of its id, else of its text."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(text_or_empty().cast("binary")))
    return F.md5(own.cast("binary"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, size) -> (source, source_size, target).

    A level of words per unit of weight is raised until the targets hold the whole budget;
    sources stop at ``MOST_EPOCHS`` times their size. Sorted by the level at which they stop,
    the stopped ones come first, so prefix sums over the sources give the level.
    """
    whole = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy("__source")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight.cast("double")).withColumn(
        "cap", MOST_EPOCHS * F.col("source_size").cast("double")
    )
    before = Window.orderBy(F.col("cap") / F.col("weight"), "__source").rowsBetween(
        Window.unboundedPreceding, -1
    )
    spent = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    gone = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    budget = SHARE * F.sum("source_size").over(whole).cast("double")
    level = (budget - spent) / (F.sum("weight").over(whole) - gone)
    levelled = ranked.withColumn("level", level)
    last = F.max(F.when(F.col("cap") / F.col("weight") > F.col("level"), F.col("level"))).over(whole)
    target = F.least(F.col("cap"), F.coalesce(last * F.col("weight"), F.col("cap")))
    return levelled.select("__source", "source_size", target.alias("target"))


def mixing_plan(docs: DataFrame) -> DataFrame:
    """One row per source: size, target, whole epochs, and the cut of the last epoch."""
    rows = docs.select(source_key().alias("__source"), random_key().alias("__key"), n_words().alias("size"))
    rows = stored(rows, "mix-rows")
    part = F.substring("__key", 1, KEY_DIGITS)
    parts = stored(
        rows.groupBy("__source", part.alias("__part")).agg(F.sum("size").alias("size")), "mix-parts"
    )
    sizes = parts.groupBy("__source").agg(F.sum("size").alias("source_size"))
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    targets = stored(
        source_targets(sizes)
        .withColumn("epochs", epochs.cast("bigint"))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size")),
        "mix-targets",
    )
    running = F.sum("size").over(Window.partitionBy("__source").orderBy("__part"))
    edge = (
        parts.withColumn("upto", running)
        .join(targets.select("__source", "rest"), "__source")
        .filter((F.col("upto") - F.col("size") <= F.col("rest")) & (F.col("rest") < F.col("upto")))
        .select("__source", "__part", (F.col("rest") - F.col("upto") + F.col("size")).alias("rest"))
    )
    near = rows.withColumn("__part", part).join(stored(edge, "mix-edge"), ["__source", "__part"])
    keys = near.groupBy("__source", "__key", "rest").agg(
        F.sum("size").alias("size"), F.count("*").alias("copies")
    )
    upto = F.sum("size").over(Window.partitionBy("__source").orderBy("__key"))
    cut = (
        keys.withColumn("upto", upto)
        .filter((F.col("upto") - F.col("size") <= F.col("rest")) & (F.col("rest") < F.col("upto")))
        .select(
            "__source",
            F.col("__key").alias("__cut_key"),
            F.floor((F.col("rest") - F.col("upto") + F.col("size")) / F.col("copies")).alias("__cut_words"),
        )
    )
    plan = targets.join(cut, "__source", "left").select(
        "__source",
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
        F.col("epochs").alias("__epochs"),
        "__cut_key",
        "__cut_words",
    )
    return stored(plan, "mix-plan")


def _with_taken(docs: DataFrame) -> DataFrame:
    joined = (
        docs.withColumn("__source", source_key())
        .withColumn("__key", random_key())
        .withColumn("__size", n_words())
        .join(mixing_plan(docs), "__source", "left")
    )
    last = (
        F.when(F.col("__key") < F.col("__cut_key"), F.col("__size"))
        .when(F.col("__key") == F.col("__cut_key"), F.least("__size", "__cut_words"))
        .otherwise(0)
    )
    taken = (F.col("__epochs") * F.col("__size") + last).cast("bigint")
    return joined.withColumn("__taken", taken)


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` plus size, source_size, target and taken (words the mix takes, with repeats).

    A document before the cut of its source's last epoch is taken once more than the whole
    epochs; the one at the cut gives the words that are left. Rows of one key at the cut share
    them evenly. Null and empty texts have no words and take none; null is a source of its
    own, the last. Columns of these four names are replaced; an empty table stays empty.
    """
    added = ("size", "source_size", "target", "taken")
    kept = [F.col(c) for c in docs.columns if c not in added]
    return _with_taken(docs).select(*kept, *[F.col(f"__{c}").alias(c) for c in added])


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, the one at a cut whole."""
    times = F.when(F.col("__size") > 0, F.ceil(F.col("__taken") / F.col("__size")))
    repeats = F.sequence(F.lit(1), F.coalesce(times, F.lit(0)).cast("int"))
    return (
        _with_taken(docs)
        .filter(F.col("__taken") > 0)
        .withColumn("__epoch", F.explode(repeats))
        .select(*docs.columns)
    )


def mix_table(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
with sized as (
  select doc_id, source, md5(cast(doc_id as varchar)) as k,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents
), sources as (
  select source, sum(size) as s, row_number() over (order by source nulls last) - 1 as r
  from sized group by source
), weighed as (
  select source, cast(s as bigint) as s, 2.0::double * s as cap,
         (case r % 3 when 0 then 5 when 1 then 2 else 1 end)::double as w
  from sources
), leveled as (
  select *, (1.5::double * sum(s) over () - coalesce(sum(cap) over before, 0)) /
            (sum(w) over () - coalesce(sum(w) over before, 0)) as level
  from weighed window before as (order by cap / w, source nulls last
                                 rows between unbounded preceding and 1 preceding)
), targets as (
  select source, s, least(cap, coalesce(max(case when cap / w > level then level end) over () * w, cap)) as target
  from leveled
), budgets as (
  select *, case when s > 0 then cast(floor(round(target) / s) as bigint) else 0 end as epochs
  from targets
), ordered as (
  select d.doc_id, d.size, b.s, b.target, b.epochs,
         cast(round(b.target) as bigint) - b.epochs * b.s as rest,
         coalesce(sum(d.size) over (partition by d.source order by d.k
                  rows between unbounded preceding and 1 preceding), 0) as before
  from sized d join budgets b on d.source is not distinct from b.source
)
select doc_id, size, s as source_size, target,
       cast(epochs * size + greatest(0, least(size, rest - before)) as bigint) as taken
from ordered
"""

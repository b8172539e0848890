"""The end-to-end jobs: training, batch export, BI marts and live scoring."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from payrisk.functions.features import Drained, add_features
from payrisk.functions.risk import project_export, project_risk, with_risk
from payrisk.operators import label_counts, marts, models, sampling
from payrisk.session import current_workspace, shared_dir
from payrisk.sources import files
from payrisk.streaming import (
    batch_console,
    batch_files,
    model_scorer,
    read_tx_stream,
    start_scoring,
)


def label_reports(featured: DataFrame) -> dict[str, DataFrame]:
    """The four label counts by output name, from one scan.

    The cells are checkpointed: few rows, but losing them would cost the scan again.
    """
    shared_dir(featured.sparkSession)
    cells = label_counts.label_cells(featured).checkpoint()
    return {
        "fraud_vs_normal": label_counts.fraud_vs_normal(cells),
        "fraud_by_type": label_counts.fraud_by_type_long(cells),
        "high_value_fraud": label_counts.high_value_fraud(cells),
        "account_drained_cases": label_counts.account_drained_cases(cells),
    }


def run_training(
    transactions: DataFrame,
    out_dir: str,
    key: str | None = None,
    drained: Drained = "strict",
    kinds: Iterable[str] = models.MODEL_KINDS,
    num_partitions: int | None = None,
    params: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Features -> label reports -> train, compare and save models -> risk of the test rows.

    Returns the model comparison. The featured table is written once, in a folder per part of
    the split, and read back: everything after it reads only the columns and the part that it
    needs, no key is hashed again, and no lineage reaches further.
    """
    spark = transactions.sparkSession
    processed = f"{out_dir}/processed_transactions"
    marked = sampling.with_split(add_features(transactions, drained), key)
    files.write_processed(marked, processed, "split")
    featured = files.read_processed(spark, processed)

    for name, report in label_reports(featured).items():
        files.write_csv(report, f"{out_dir}/{name}")

    train, test = (featured.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
    fitted = models.train_all(train, kinds, num_partitions, params)
    comparison = models.model_comparison(fitted, test)
    models.save_models(fitted, f"{out_dir}/models")

    best = "gbt" if "gbt" in fitted else next(iter(fitted))
    files.write_csv(project_risk(models.score(fitted[best], test)), f"{out_dir}/final_risk_scores")
    return comparison


def run_export(
    transactions: DataFrame,
    model: PipelineModel,
    out_dir: str,
    drained: Drained = "strict",
    extra: tuple[str, ...] = (),
) -> str:
    """Score a whole table and write it as CSV parts. A map: no shuffle, nothing kept."""
    path = f"{out_dir}/fraud_predictions"
    write_scored(models.score_transactions(transactions, model, drained), path, extra)
    return path


def write_scored(scored: DataFrame, path: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Write scored rows as CSV parts and return their headline figures.

    The figures are observed by the very tasks that write, so they cost no second scan and
    are those of the rows in the files.
    """
    seen = Observation("export")
    files.write_csv(project_export(scored.observe(seen, *marts.kpi_sums(scored)), *extra), path)
    figures = seen.get
    kinds = scored.agg(*marts.kpi_sums(scored)).schema
    row = tuple(figures[name] for name in kinds.fieldNames())
    return marts.kpis_of_sums(scored.sparkSession.createDataFrame([row], kinds))


def build_marts(
    scored: DataFrame,
    labels: DataFrame | None = None,
    limit: int | None = None,
    key: str | None = None,
) -> dict[str, DataFrame]:
    """The BI tables by output name.

    ``scored`` carries amount, prediction and fraud_probability; ``labels`` the saved
    (type, isFraud, count) rows. One scan makes the cells behind all the aggregates; the
    fact table holds every row, or with a ``limit`` the frauds and a sample of the others.
    """
    shared_dir(scored.sparkSession)
    risky = with_risk(scored)
    if limit is not None:  # the sample reads it several times, what it was scored by runs once
        risky = current_workspace(scored.sparkSession).stored(risky, "risky")
    cells = marts.scored_cells(risky).checkpoint()
    facts = risky if limit is None else sampling.downsample_exact(risky, limit, key)
    tables = {
        "transactions_scored": facts,
        "summary_kpis": marts.summary_kpis(cells),
        "risk_level_summary": marts.risk_level_summary(cells),
        "amount_buckets": marts.amount_buckets(cells),
    }
    if labels is not None:
        tables["fraud_by_type"] = label_counts.fraud_by_type_from_counts(labels)
    return tables


def write_marts(tables: Mapping[str, DataFrame], out_dir: str) -> dict[str, str]:
    """One CSV file per table, ``<name>.csv``; the fact table, of any size, is a folder of parts."""
    paths = {}
    for name, table in tables.items():
        whole = name == "transactions_scored"
        paths[name] = f"{out_dir}/{name}" if whole else f"{out_dir}/{name}.csv"
        (files.write_csv if whole else files.write_named_csv)(table, paths[name])
    return paths


def run_stream(
    spark: SparkSession,
    model: PipelineModel,
    out_dir: str,
    events: DataFrame | None = None,
    drained: Drained = "strict",
    console: bool = True,
    **trigger,
) -> StreamingQuery:
    """Score a message stream (Kafka unless given) into CSV files and onto the console.

    Messages that cannot be scored go to ``dead_letters`` with the reason. A batch counts when
    both folders have it: readers use ``read_committed`` with the log in ``stream_commits``.
    """
    events = events if events is not None else read_tx_stream(spark)
    sinks = [batch_files(f"{out_dir}/stream_predictions")]
    if console:
        sinks.append(batch_console())
    return start_scoring(
        events, model_scorer(model), sinks, batch_files(f"{out_dir}/dead_letters"),
        f"{out_dir}/stream_checkpoint", drained, commit_log=f"{out_dir}/stream_commits", **trigger,
    )

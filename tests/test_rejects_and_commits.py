"""Rejected lines and messages, commit logs, named files, observed exports, workspaces."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from payrisk import operators as ops
from payrisk.functions import add_features, rule_score
from payrisk.plans import write_scored
from payrisk.schema import TX_SCHEMA
from payrisk.session import Workspace, current_workspace, shared_dir, workspace
from payrisk.sources import (
    classify_events,
    encode_events,
    read_checked_transactions,
    read_transactions,
    write_csv,
    write_named_csv,
)
from payrisk.streaming import (
    batch_files,
    committed_batches,
    note_commit,
    read_committed,
    read_tx_stream,
    start_fanout,
    start_scoring,
)

HEADER = ",".join(TX_SCHEMA.fieldNames())
GOOD = "1,TRANSFER,10.5,C1,20.0,9.5,M1,0.0,10.5,0,0"


# ---- CSV lines


@pytest.fixture
def lines(tmp_path):
    bad = [
        "x,TRANSFER,10.5,C1,20.0,9.5,M1,0.0,10.5,0,0",
        "1,TRANSFER,much,C1,20.0,9.5,M1,0.0,10.5,0,0",
        "1,TRANSFER,10.5",
        f"{GOOD},extra",
    ]
    Path(tmp_path, "a.csv").write_text("\n".join([HEADER, GOOD, *bad, GOOD]) + "\n")
    return str(tmp_path / "a.csv"), bad


def test_every_line_is_a_row_or_rejected(spark, lines):
    path, bad = lines
    good, rejected = read_checked_transactions(spark, path)
    assert good.schema == TX_SCHEMA and good.count() == 2
    assert sorted(r[0] for r in rejected.collect()) == sorted(bad)
    assert good.select("type").count() == 2 and good.agg(F.sum("amount")).first()[0] == 21.0


def test_modes_of_a_plain_read(spark, lines):
    path, _ = lines
    assert read_transactions(spark, path).filter("amount IS NULL").count() == 1
    assert read_transactions(spark, path, mode="DROPMALFORMED").count() == 2
    with pytest.raises(Exception, match="FAILFAST"):
        read_transactions(spark, path, mode="FAILFAST").collect()


def test_checked_read_of_nothing_wrong_and_of_no_rows(spark, tx_small, tmp_path):
    plain = tx_small.drop("tx_id")
    write_csv(plain, str(tmp_path / "tx"))
    good, rejected = read_checked_transactions(spark, str(tmp_path / "tx"))
    assert rejected.isEmpty() and good.exceptAll(plain).isEmpty() and good.count() == plain.count()
    Path(tmp_path, "none.csv").write_text(HEADER + "\n")
    good, rejected = read_checked_transactions(spark, str(tmp_path / "none.csv"))
    assert good.isEmpty() and rejected.isEmpty()


# ---- messages


MESSAGES = {
    "plain": (json.dumps({"step": 1, "type": "TRANSFER", "amount": 5.0}), None),
    "cut": ('{"step": 1, "type": "TR', "malformed"),
    "text": ("hello", "malformed"),
    "blank": ("  ", "empty"),
    "null": (None, "empty"),
    "word": ('{"step": 1, "amount": "much"}', "bad_value"),
    "type": ('{"step": "soon", "amount": 1.5}', "bad_value"),
    "more": ('{"step": 1, "amount": 2.0, "colour": "red"}', None),
}


def test_every_message_has_a_reason_or_none(spark):
    rows = [(None if v is None else v.encode(), i, k) for i, (k, (v, _)) in enumerate(MESSAGES.items())]
    events = spark.createDataFrame(rows, "value binary, offset long, topic string")
    got = {r["topic"]: r for r in classify_events(events).collect()}
    assert {k: got[k]["reject_reason"] for k in got} == {k: reason for k, (_, reason) in MESSAGES.items()}
    assert got["word"]["raw_value"] == MESSAGES["word"][0].encode() and got["word"]["offset"] == 5
    assert got["plain"]["amount"] == 5.0


@pytest.fixture
def feed(tx_small, tmp_path):
    some = tx_small.orderBy("tx_id").limit(200)
    folder = str(tmp_path / "feed")
    texts = encode_events(some).select(F.col("value").cast("string"))
    texts.repartition(4).write.text(folder)
    Path(folder, "part-bad.txt").write_text('{"step": oops\n{"step": 1, "amount": "x"}\n{"step": 1}\n')
    return folder, some


def scoring(spark, feed, out, scorer=rule_score):
    events = read_tx_stream(spark, "text", {"maxFilesPerTrigger": "2"}, path=feed)
    return start_scoring(
        events, scorer, [batch_files(f"{out}/csv"), batch_files(f"{out}/pq", "parquet")],
        batch_files(f"{out}/dead", "parquet"), f"{out}/checkpoint", keep=("tx_id",),
        commit_log=f"{out}/log", availableNow=True,
    )


def test_received_is_scored_and_quarantined(spark, feed, tmp_path):
    folder, some = feed
    out = str(tmp_path / "out")
    scoring(spark, folder, out).awaitTermination()
    schema = "tx_id string, step int, type string, amount double"
    for name, fmt in (("csv", "csv"), ("pq", "parquet")):
        path = f"{out}/{name}"
        whole = spark.read.option("header", True).format(fmt).load(path).drop("run", "batch_id").schema
        rows = read_committed(spark, f"{out}/log", path, whole if fmt == "csv" else schema, fmt)
        assert rows.count() == 200
        assert {r.tx_id for r in rows.collect()} == {r.tx_id for r in some.collect()}
    dead = read_committed(spark, f"{out}/log", f"{out}/dead", "raw_value string, reject_reason string", "parquet")
    assert {r.raw_value: r.reject_reason for r in dead.collect()} == {
        '{"step": oops': "malformed", '{"step": 1, "amount": "x"}': "bad_value", '{"step": 1}': "missing_input",
    }


def test_failure_between_two_sinks_shows_neither(spark, feed, tmp_path):
    folder, some = feed
    out, failed = str(tmp_path / "out"), []

    def fragile(batch, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    sinks = [batch_files(f"{out}/one", "parquet"), fragile, batch_files(f"{out}/two", "parquet")]
    events = read_tx_stream(spark, "text", {"maxFilesPerTrigger": "2"}, path=folder)

    def run():
        start_fanout(events, sinks, f"{out}/checkpoint", f"{out}/log", availableNow=True).awaitTermination()

    def seen(name):
        return read_committed(spark, f"{out}/log", f"{out}/{name}", "value string", "parquet").count()

    with pytest.raises(Exception, match="lost"):
        run()
    written = spark.read.parquet(f"{out}/one").count()
    assert [b for _, b in committed_batches(spark, f"{out}/log")] == [0]
    assert seen("one") == seen("two") < written
    run()
    assert seen("one") == seen("two") == 203


def test_notes_may_be_repeated_and_an_empty_log_reads_as_no_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    assert committed_batches(spark, log) == []
    assert read_committed(spark, log, str(tmp_path), TX_SCHEMA).count() == 0
    for _ in range(2):
        note_commit(spark, log, "r", 10)
        note_commit(spark, log, "r", 9)
    assert committed_batches(spark, log) == [("r", 9), ("r", 10)]


# ---- files and figures


def test_named_file_is_one_file_and_is_replaced(spark, tmp_path):
    path = tmp_path / "bi" / "summary_kpis.csv"
    for n in (5, 3):
        write_named_csv(spark.range(n).repartition(3), str(path))
        assert path.is_file() and path.read_text().splitlines()[0] == "id"
        assert spark.read.option("header", True).csv(str(path)).count() == n
    assert [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["summary_kpis.csv"]


def test_named_file_of_a_failed_query_leaves_the_old_one(spark, tmp_path):
    path = tmp_path / "t.csv"
    write_named_csv(spark.range(2), str(path))
    with pytest.raises(Exception, match="no such"):
        write_named_csv(spark.range(2).select(F.raise_error(F.lit("no such"))), str(path))
    assert path.read_text().splitlines() == ["id", "0", "1"]
    assert len([p for p in tmp_path.iterdir() if p.is_dir()]) == 0


def test_export_observes_its_figures_in_the_pass_that_writes(spark, tx_small, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = tx_small.mapInArrow(counted, tx_small.schema)
    scored = rule_score(add_features(watched))
    got = write_scored(scored, str(tmp_path / "rows"), ("tx_id",)).first()
    assert seen.value == tx_small.count()
    assert got == ops.summary_kpis(rule_score(add_features(tx_small))).first()
    nothing = write_scored(rule_score(add_features(tx_small.limit(0))), str(tmp_path / "none"))
    assert nothing.first()["total_transactions"] == 0 and nothing.first()["total_amount"] == 0.0


# ---- workspaces


def folders(spark):
    return {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("payrisk-*")}


def test_workspace_deletes_what_it_stored_also_after_a_failure(spark):
    before = folders(spark)
    with workspace(spark) as work:
        assert current_workspace(spark) is work
        assert work.stored(spark.range(5)).count() == 5
        with pytest.raises(ZeroDivisionError), workspace(spark) as inner:
            inner.stored(spark.range(3))
            kept = inner.outer.stored(spark.range(4))
            assert len(folders(spark) - before) == 3
            raise ZeroDivisionError
        assert kept.count() == 4 and len(folders(spark) - before) == 2
    assert folders(spark) == before
    assert current_workspace(spark) is not work


def test_query_in_a_workspace_leaves_no_folder(spark, tmp_path):
    from conftest import SMALL
    from payrisk.plans.catalog import QUERIES

    QUERIES["rule_auc"](spark, SMALL)  # stores what all queries of the session share
    before = folders(spark)
    for name in ("rule_auc", "csv_rejects", "downsample_exact"):
        with workspace(spark):
            QUERIES[name](spark, SMALL).write.parquet(str(tmp_path / name))
        assert folders(spark) == before
        assert spark.read.parquet(str(tmp_path / name)).count() > 0


def test_local_folder_on_a_cluster_raises(spark, monkeypatch):
    class Cluster:
        _jvm, _jsc = spark._jvm, spark._jsc

        class conf:
            get = staticmethod(lambda key, *default: default[0] if default else "file:/here/warehouse")

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)
    assert isinstance(current_workspace(spark), Workspace)


def test_kept_batch_holds_raw_messages_of_dead_letters_only(spark, feed, tmp_path):
    folder, _ = feed
    out, raw_seen = str(tmp_path / "out"), []

    def scorer(df):
        raw_seen.append(df.filter(F.col("raw_value").isNotNull()).count())
        return rule_score(df)

    scoring(spark, folder, out, scorer).awaitTermination()
    dead = read_committed(spark, f"{out}/log", f"{out}/dead", "raw_value string, reject_reason string", "parquet")
    assert raw_seen and set(raw_seen) == {0}
    assert dead.filter(F.col("raw_value").isNotNull()).count() == 3

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from payrisk import operators as ops
from payrisk.functions import add_features, project_stream, rule_score
from payrisk.schema import SCORED_SCHEMA, TX_SCHEMA
from payrisk.sources import (
    decode_events,
    encode_events,
    read_csv_parts,
    read_scored,
    read_transactions,
    write_csv,
    write_mart,
    write_processed,
)
from payrisk.streaming import (
    batch_files,
    kafka_options,
    model_scorer,
    read_tx_stream,
    score_stream,
    start_console_sink,
    start_csv_sink,
    start_fanout,
)

STREAM_ROWS = 500
OUTPUT = ["step", "type", "amount", "prediction", "fraud_probability", "risk_score", "risk_level"]


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


# ---- files


def test_csv_round_trip(spark, tx_small, tmp_path):
    plain = tx_small.drop("tx_id")
    write_csv(plain.repartition(3), str(tmp_path / "tx"))
    back = read_transactions(spark, str(tmp_path / "tx"))
    assert back.schema == TX_SCHEMA
    assert same(plain, back)
    assert read_transactions(spark, str(tmp_path / "tx"), 5).rdd.getNumPartitions() == 5


def test_headers_in_another_order_are_refused(spark, tx_small, tmp_path):
    swapped = tx_small.select("type", "step", *TX_SCHEMA.fieldNames()[2:])
    write_csv(swapped, str(tmp_path / "tx"))
    with pytest.raises(Exception, match="header"):
        read_transactions(spark, str(tmp_path / "tx")).collect()


def test_missing_and_empty_folders_have_no_rows(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for name in ("missing", "empty"):
        df = read_scored(spark, str(tmp_path / name))
        assert df.schema == SCORED_SCHEMA
        assert df.count() == 0


def test_other_read_errors_are_not_hidden(spark, tmp_path):
    with pytest.raises(Exception):
        read_csv_parts(spark, "nosuchscheme://x/y", SCORED_SCHEMA).collect()


def test_marts_are_one_file_and_tables_replace(spark, tmp_path):
    df = spark.range(10).repartition(4)
    for _ in range(2):
        write_mart(df, str(tmp_path / "mart"))
    assert len(list((tmp_path / "mart").glob("part-*.csv"))) == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "mart")).count() == 10


def test_processed_table_can_be_partitioned(spark, tx_small, tmp_path):
    write_processed(add_features(tx_small), str(tmp_path / "p"), "type")
    assert (tmp_path / "p" / "type=TRANSFER").is_dir()
    assert spark.read.parquet(str(tmp_path / "p")).count() == tx_small.count()


# ---- messages


def test_messages_are_plain_json(tx_small):
    value = encode_events(tx_small.drop("tx_id")).first()["value"]
    assert set(json.loads(bytes(value))) <= set(TX_SCHEMA.fieldNames())


def test_decoding_odd_messages(spark):
    texts = ['{"step": 1, "type"', '{"amount": 2.5}', '{"amount": 1.0, "extra": "x"}', "[]"]
    events = spark.createDataFrame([(bytearray(t, "utf-8"),) for t in texts], "value binary")
    assert [r["amount"] for r in decode_events(events).collect()] == [None, 2.5, 1.0, None]


# ---- streams


@pytest.fixture
def feed(tx_small, tmp_path):
    """500 messages in several files and a malformed one, as the folder of a text stream."""
    some = tx_small.orderBy("tx_id").limit(STREAM_ROWS)
    folder = str(tmp_path / "feed")
    texts = encode_events(some).select(F.col("value").cast("string"))
    texts.repartition(4).write.text(folder)
    Path(folder, "part-bad.txt").write_text('{"step": oops\n')
    return folder, some


def events_of(spark, folder, **options):
    return read_tx_stream(spark, "text", {"maxFilesPerTrigger": "2", **options}, path=folder)


def test_stream_equals_batch(spark, feed, tmp_path):
    folder, some = feed
    scored = score_stream(events_of(spark, folder), rule_score)
    assert scored.columns == OUTPUT
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = start_csv_sink(scored, out, checkpoint, availableNow=True)
    query.awaitTermination()
    streamed = read_csv_parts(spark, out, scored.schema)
    batch = project_stream(rule_score(add_features(some)))
    assert streamed.count() == STREAM_ROWS
    assert same(streamed, batch)
    intake = [p.observedMetrics["intake"] for p in query.recentProgress if p.observedMetrics]
    assert sum(m["received"] for m in intake) == STREAM_ROWS + 1
    assert sum(m["unscorable"] for m in intake) == 1

    again = start_csv_sink(scored, out, checkpoint, availableNow=True)
    again.awaitTermination()
    assert read_csv_parts(spark, out, scored.schema).count() == STREAM_ROWS


def test_stream_scores_with_a_model(spark, feed, tmp_path):
    folder, some = feed
    train = add_features(spark.read.parquet(some.inputFiles()[0].rsplit("/", 1)[0]))
    model = ops.train(train, "gbt", maxIter=2)
    scored = score_stream(events_of(spark, folder), model_scorer(model), keep=("tx_id",))
    out = str(tmp_path / "out")
    start_csv_sink(scored, out, str(tmp_path / "c"), availableNow=True).awaitTermination()
    batch = ops.score_transactions(some, model).select("tx_id", *OUTPUT)
    assert same(read_csv_parts(spark, out, scored.schema), batch)


def test_fanout_feeds_every_sink_and_repeats_safely(spark, feed, tmp_path):
    folder, _ = feed
    scored = score_stream(events_of(spark, folder), rule_score)
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "pq")
    calls = []

    def fragile(batch, batch_id):
        """Fails once, after the other sinks have written the second batch."""
        calls.append(batch_id)
        if calls.count(1) == 1 and batch_id == 1:
            raise RuntimeError("lost")

    sinks = [batch_files(csv), batch_files(parquet, "parquet"), fragile]

    def run():
        query = start_fanout(scored, sinks, str(tmp_path / "c"), availableNow=True)
        query.awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert calls.count(1) == 2
    assert spark.read.parquet(parquet).count() == STREAM_ROWS
    assert spark.read.option("header", True).csv(csv).count() == STREAM_ROWS


def test_fanout_keeps_what_another_query_wrote(spark, feed, tmp_path):
    """A new checkpoint counts its batches from 0 again; its rows come beside the earlier ones."""
    folder, _ = feed
    out = str(tmp_path / "pq")
    for run in ("first", "second"):
        scored = score_stream(events_of(spark, folder), rule_score)
        sinks = [batch_files(out, "parquet")]
        start_fanout(scored, sinks, str(tmp_path / run), availableNow=True).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 2 * STREAM_ROWS and rows.select("run").distinct().count() == 2


def test_console_sink(spark, feed):
    query = start_console_sink(score_stream(events_of(spark, feed[0]), rule_score))
    try:
        query.processAllAvailable()
        assert sum(p.numInputRows for p in query.recentProgress) == STREAM_ROWS + 1
    finally:
        query.stop()


def test_live_scoring_job(spark, feed, tmp_path):
    from payrisk.plans import run_stream

    folder, some = feed
    model = ops.train(add_features(some), "lr", maxIter=5)
    out = str(tmp_path / "live")
    query = run_stream(
        spark, model, out, events_of(spark, folder), console=False, availableNow=True
    )
    query.awaitTermination()
    rows = spark.read.option("header", True).csv(f"{out}/stream_predictions")
    assert rows.count() == STREAM_ROWS


def test_kafka_options(monkeypatch):
    monkeypatch.delenv("KAFKA_BOOTSTRAP", raising=False)
    monkeypatch.delenv("KAFKA_TOPIC", raising=False)
    assert kafka_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "transactions",
        "startingOffsets": "latest",
    }
    monkeypatch.setenv("KAFKA_TOPIC", "payments")
    options = kafka_options("b:1", max_offsets_per_trigger=10, min_partitions=4)
    assert options["subscribe"] == "payments"
    assert options["kafka.bootstrap.servers"] == "b:1"
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("10", "4")


def test_command_line_lists_its_commands():
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run(
        [sys.executable, "-m", "payrisk", "--help"],
        cwd=root, capture_output=True, text=True, timeout=120,
    )
    assert done.returncode == 0
    for command in ("train", "export", "marts", "stream", "score", "publish", "distributions"):
        assert command in done.stdout

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgermill.sources import kafka
from ledgermill.sources.warehouse import Warehouse
from ledgermill.streaming import decode, ledger, late, sinks, volume
from ledgermill.verification import queries


def card(i, when, amount=10.0, branch="BR_001"):
    return {
        "event_type": "CARD_TRANSACTION", "transaction_id": f"T{i}", "customer_id": "C", "branch_id": branch,
        "amount": amount, "transaction_type": "DEPOSIT", "timestamp": when, "unlisted_field": 1,
    }


MIXED = [
    json.dumps(card(1, "2024-01-01 10:00:30.000001")),
    json.dumps({k: v for k, v in card(2, "2024-01-01 10:02:00").items() if k != "event_type"}),
    json.dumps({"event_type": "CUSTOMER_ONBOARDED", "customer_id": "C", "credit_score": 700, "branch_id": "BR_001",
                "customer_segment": "BASIC", "initial_balance": 5.5, "timestamp": "2024-01-01 10:00:30.5"}),
    json.dumps({"event_type": "EMI_PAYMENT_EVENT", "loan_id": "L", "customer_id": "C", "emi_amount": 7.0,
                "status": "PAID", "timestamp": "2024-01-01 10:00:30.000001"}),
    json.dumps({"event_type": "NEW_BRANCH_OPENED", "branch_id": "BR_063", "opening_date": "2024-01-01",
                "monthly_cost": 1500000, "timestamp": "2024-01-01 10:00:30.000001"}),
    json.dumps({"event_type": "MYSTERY", "timestamp": "2024-01-01 10:00:30.000001"}),
    json.dumps(card(9, "not a time")),
    "{broken",
]


@pytest.fixture(scope="module")
def events(spark):
    messages = spark.createDataFrame([(m,) for m in MIXED], "value string").select(F.col("value").cast("binary"))
    return decode.decode(messages)


def test_routes_cover_every_event(events):
    got = {r.route: r.event_count for r in decode.route_summary(events).collect()}
    assert got == {
        "CARD_TRANSACTION": 1 + 1, "CUSTOMER_ONBOARDED": 1, "EMI_PAYMENT_EVENT": 1, "NEW_BRANCH_OPENED": 1,
        "QUARANTINE": 3,
    }


def test_typed_streams(events):
    cards = decode.typed_events(events, "CARD_TRANSACTION")
    assert {r.transaction_id for r in cards.collect()} == {"T1", "T2"}
    onboarded = decode.typed_events(events, "CUSTOMER_ONBOARDED").first()
    assert (onboarded.credit_score, onboarded.initial_balance) == (700, 5.5)
    assert decode.typed_events(events, "NEW_BRANCH_OPENED").first().monthly_cost == 1500000
    assert "{broken" in {r._corrupt_record for r in decode.quarantined_events(events).collect()}


def test_batch_windows_match_plain_windows(spark, events):
    rows = [(f"T{i}", f"BR_{i % 3}", i / 4, f"2024-01-01 10:{i % 60:02d}:{i % 50:02d}") for i in range(300)]
    df = spark.createDataFrame(rows, "transaction_id string, branch_id string, amount double, t string").withColumn(
        "event_time", F.to_timestamp("t")
    )
    panes = volume.batch_volume(df)
    plain = volume.stream_volume(df)
    key = lambda r: (r.window_start, r.branch_id)
    assert sorted(panes.collect(), key=key) == sorted(plain.collect(), key=key)
    with pytest.raises(ValueError):
        volume.batch_volume(df, 5, 2)


def run_stream(spark, tmp_path, batches):
    """Feed one file per micro-batch and return the query and the lake folder."""
    source, out, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    query = None
    for number, lines in enumerate(batches):
        (tmp_path / "in" / f"{number}.json").write_text("\n".join(json.dumps(e) for e in lines) + "\n")
        stream = kafka.read_json_files(spark, source, files_per_batch=1)
        cards = decode.typed_events(decode.decode(stream), "CARD_TRANSACTION")
        query = sinks.to_lake(volume.stream_volume(cards), out, state, available_now=True)
        query.awaitTermination()
    return query, out


def test_stream_updates_and_restart(spark, tmp_path):
    _, out = run_stream(
        spark, tmp_path,
        [[card(1, "2024-01-01 10:00:30"), card(2, "2024-01-01 10:00:40")], [card(3, "2024-01-01 10:01:10", 5.5)]],
    )
    rows = {str(r.window_start)[11:16]: r for r in sinks.latest_windows(spark, out).collect()}
    assert len(rows) == 6
    assert (rows["10:00"].window_total_volume, rows["10:00"].window_txn_count) == (25.5, 3)
    assert rows["09:56"].window_txn_count == 2
    assert rows["10:01"].window_txn_count == 1


def test_broken_events_are_kept_once(spark, tmp_path):
    """Also when a query is started again over what it has already seen."""
    (tmp_path / "in").mkdir()
    untimed = card(2, "no time")
    for number, lines in enumerate([[json.dumps(card(1, "2024-01-01 10:00:30")), "{broken"], [json.dumps(untimed)]]):
        (tmp_path / "in" / f"{number}.json").write_text("\n".join(lines) + "\n")
        for _ in range(2):
            events = decode.decode(kafka.read_json_files(spark, str(tmp_path / "in")))
            bad = decode.quarantined_events(events)
            sinks.keep_events(bad, str(tmp_path / "bad"), str(tmp_path / "state"), available_now=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_late_event_is_dropped_after_a_filler_batch(spark, tmp_path):
    early, late = card(1, "2024-01-01 10:00:30"), card(2, "2024-01-01 10:00:45")
    ahead, filler = card(3, "2024-01-01 11:00:00"), card(4, "2024-01-01 11:00:05")
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    query, dropped = run_stream(spark, tmp_path / "a", [[early], [ahead], [filler], [late]])
    assert sinks.late_rows_dropped(query) == 5
    counts = {str(r.window_start)[11:16]: r.window_txn_count for r in sinks.latest_windows(spark, dropped).collect()}
    assert counts["10:00"] == 1


def test_state_partitions_leave_the_session_alone(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text(json.dumps(card(1, "2024-01-01 10:00:30")) + "\n")
    cards = decode.typed_events(
        decode.decode(kafka.read_json_files(spark, str(tmp_path / "in"))), "CARD_TRANSACTION"
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out, state = str(tmp_path / "out"), tmp_path / "state"
    query = sinks.to_lake(volume.stream_volume(cards), out, str(state), True, state_partitions=3)
    query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert sorted(p.name for p in (state / "state" / "0").iterdir() if p.name.isdigit()) == ["0", "1", "2"]
    assert sinks.latest_windows(spark, out).count() == 5


def test_console_sink(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text(json.dumps(card(1, "2024-01-01 10:00:30")) + "\n")
    cards = decode.typed_events(
        decode.decode(kafka.read_json_files(spark, str(tmp_path / "in"))), "CARD_TRANSACTION"
    )
    query = sinks.to_console(volume.stream_volume(cards), str(tmp_path / "state"))
    query.processAllAvailable()
    assert sum(p.numInputRows for p in query.recentProgress) == 1
    query.stop()


def test_rocksdb_state(spark, tmp_path):
    key, provider = next(iter(sinks.ROCKSDB.items()))
    old = spark.conf.get(key)
    spark.conf.set(key, provider)
    try:
        _, out = run_stream(spark, tmp_path, [[card(1, "2024-01-01 10:00:30")]])
    finally:
        spark.conf.set(key, old)
    assert sinks.latest_windows(spark, out).count() == 5


def test_messages(spark):
    df = spark.createDataFrame([("k", 1.5)], "id string, amount double")
    row = kafka.as_messages(df, "id").selectExpr("CAST(key AS STRING) k", "CAST(value AS STRING) v").first()
    assert (row.k, json.loads(row.v)) == ("k", {"id": "k", "amount": 1.5})
    assert kafka.as_messages(df).columns == ["value"]


def test_topic_reader_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_topic(spark, "nowhere:1")


def test_warehouse_sink_keeps_the_lake_copy(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text(json.dumps(card(1, "2024-01-01 10:00:30")) + "\n")
    cards = decode.typed_events(
        decode.decode(kafka.read_json_files(spark, str(tmp_path / "in"))), "CARD_TRANSACTION"
    )
    out = str(tmp_path / "out")
    query = sinks.to_lake_and_warehouse(
        volume.stream_volume(cards), out, Warehouse("jdbc:none://x/y"), "volume", str(tmp_path / "state"), True
    )
    with pytest.raises(Exception):
        query.awaitTermination()  # no driver for the address
    assert sinks.latest_windows(spark, out).count() == 5


def test_surges(spark):
    """Windows of five minutes; the quiet one at 10:15 has no row and counts as zero."""
    rows = [("b", f"2024-01-01 10:{m:02d}:00", n) for m, n in [(0, 2), (5, 2), (10, 2), (20, 5), (25, 2), (22, 9)]]
    df = spark.createDataFrame(rows, "branch_id string, t string, window_txn_count bigint").withColumn(
        "window_start", F.to_timestamp("t")
    )
    got = [(r.t[14:16], r.trailing_total) for r in volume.surges(df, 3, 3.0).collect()]
    assert sorted(got) == [("20", 4), ("22", 0)]


def test_late_rows_are_counted_over_all_reports(spark, tmp_path):
    """More reports than are kept: the late row is dropped early on and stays counted."""
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key)
    spark.conf.set(key, "2")
    counter = late.LateRows.of(spark)
    times = ["10:00:30", "11:00:00", "11:00:05", "10:00:45", *[f"11:0{i}:00" for i in range(1, 7)]]
    (tmp_path / "in").mkdir()
    try:
        for i, t in enumerate(times):
            (tmp_path / "in" / f"{i}.json").write_text(json.dumps(card(i, f"2024-01-01 {t}")) + "\n")
            os.utime(tmp_path / "in" / f"{i}.json", (1e9 + i, 1e9 + i))
        stream = kafka.read_json_files(spark, str(tmp_path / "in"), files_per_batch=1)
        cards = decode.typed_events(decode.decode(stream), "CARD_TRANSACTION")
        query = sinks.to_lake(volume.stream_volume(cards), str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
        query.awaitTermination()
        assert counter.dropped(query) == 5 and counter.reports(query) >= len(times)
        assert sinks.late_rows_dropped(query) == 0
    finally:
        spark.conf.set(key, old)
        spark.streams.removeListener(counter)


def emitted(spark, counts):
    rows = [(f"2024-01-01 10:0{m}:00", b, float(n), n) for (m, b), n in counts.items()]
    df = spark.createDataFrame(rows, "t string, branch_id string, window_total_volume double, window_txn_count bigint")
    start = F.to_timestamp("t")
    return df.select(start.alias("window_start"), (start + F.expr("INTERVAL 5 MINUTES")).alias("window_end"), "branch_id", "window_total_volume", "window_txn_count")


def counts_of(spark, path):
    return {(r.window_start.minute, r.branch_id): r.window_txn_count for r in ledger.windows(spark, path).collect()}


def test_ledger_replays_and_crashes(spark, tmp_path):
    path = str(tmp_path / "lake")
    with pytest.raises(ValueError):
        ledger.windows(spark, path)
    assert ledger.save_batch(emitted(spark, {(0, "a"): 1, (1, "a"): 1}), 0, path)
    assert not ledger.save_batch(emitted(spark, {(0, "a"): 99}), 0, path)
    # A crash between write and commit leaves a folder that no reader sees.
    emitted(spark, {(0, "a"): 7}).write.parquet(ledger.Ledger(spark, path).folder(ledger.new_name("batch", 1)))
    assert counts_of(spark, path) == {(0, "a"): 1, (1, "a"): 1}
    assert ledger.save_batch(emitted(spark, {(0, "a"): 2, (0, "b"): 1}), 1, path)
    # Two drivers that both commit a batch: one of them counts.
    again = ledger.Ledger(spark, path)
    name = ledger.new_name("batch", 1)
    emitted(spark, {(0, "a"): 2, (0, "b"): 1}).write.parquet(again.folder(name))
    again.commit(name)
    want = {(0, "a"): 2, (1, "a"): 1, (0, "b"): 1}
    assert counts_of(spark, path) == want and len(again.entries()) == 2


def test_ledger_compaction_keeps_the_windows(spark, tmp_path):
    path = str(tmp_path / "lake")
    for number in range(4):
        ledger.save_batch(emitted(spark, {(0, "a"): number + 1, (number, "b"): number}), number, path)
    before = counts_of(spark, path)
    assert ledger.compact(spark, path) and not ledger.compact(spark, path)
    book = ledger.Ledger(spark, path)
    assert [e.kind for e in book.entries()] == ["upto"] and counts_of(spark, path) == before
    assert book.expire() == 8 and counts_of(spark, path) == before
    assert not ledger.save_batch(emitted(spark, {(0, "a"): 50}), 2, path)
    ledger.save_batch(emitted(spark, {(0, "a"): 50}), 4, path)
    assert counts_of(spark, path) == {**before, (0, "a"): 50}


def test_stream_through_the_ledger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, t in enumerate(["10:00:30", "10:00:40", "10:01:10"]):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(card(i, f"2024-01-01 {t}")) + "\n")
    cards = decode.typed_events(decode.decode(kafka.read_json_files(spark, str(tmp_path / "in"), files_per_batch=1)), "CARD_TRANSACTION")
    out = str(tmp_path / "out")
    ledger.to_ledger(volume.stream_volume(cards), out, str(tmp_path / "state"), available_now=True).awaitTermination()
    rows = {str(r.window_start)[11:16]: r.window_txn_count for r in ledger.windows(spark, out).collect()}
    assert rows["10:00"] == 3 and rows["09:56"] == 2 and len(rows) == 6
    assert len(ledger.Ledger(spark, out).entries()) >= 3


def test_ledger_query_keeps_its_state_on_disk(spark, tmp_path, monkeypatch):
    """Every window stays open, so none is held in memory; over its four batches none is lost."""
    rows = [(i, f"2024-01-01 {i % 24:02d}:{i % 7:02d}:30", i % 5, "click", 1.0 + i) for i in range(200)]
    events = spark.createDataFrame(rows, "event_id bigint, t string, user_id bigint, event_type string, value double")
    events.withColumn("ts", F.to_timestamp_ntz("t")).drop("t").write.parquet(str(tmp_path / "events.parquet"))
    spark.range(3).withColumnRenamed("id", "s_suppkey").write.parquet(str(tmp_path / "supplier.parquet"))
    monkeypatch.setattr(queries, "fresh_folder", lambda _, purpose: str(tmp_path / purpose))
    settings = {key: spark.conf.get(key, None) for key in (*sinks.ROCKSDB, "spark.sql.shuffle.partitions")}
    got, want = (queries.REGISTRY[f"branch_volume_{kind}"](spark, str(tmp_path)).collect() for kind in ("ledger", "batch"))
    assert {key: spark.conf.get(key, None) for key in settings} == settings
    key = lambda r: (r.window_start, r.branch_id)
    assert len(got) > 200 and sorted(got, key=key) == sorted(want, key=key)
    batches = list((tmp_path / "ledger-state" / "offsets").glob("[0-9]*"))
    assert len(batches) == 4
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert all(json.loads(b.read_text().splitlines()[1])["conf"][provider] == sinks.ROCKSDB[provider] for b in batches)
    files = {p.suffix for p in (tmp_path / "ledger-state" / "state").rglob("*") if p.is_file()}
    assert ".zip" in files and ".delta" not in files


@pytest.mark.parametrize(("first", "then", "kind"), [(None, sinks.ROCKSDB, ".delta"), (sinks.ROCKSDB, None, ".zip")])
def test_a_checkpoint_keeps_its_state_store(spark, tmp_path, first, then, kind):
    out, state = str(tmp_path / "out"), tmp_path / "state"
    (tmp_path / "in").mkdir()
    for number, settings in enumerate((first, then)):
        (tmp_path / "in" / f"{number}.json").write_text(json.dumps(card(number, "2024-01-01 10:00:30")) + "\n")
        cards = decode.typed_events(decode.decode(kafka.read_json_files(spark, str(tmp_path / "in"))), "CARD_TRANSACTION")
        ledger.to_ledger(volume.stream_volume(cards), out, str(state), True, 2, settings).awaitTermination()
    assert [r.window_txn_count for r in ledger.windows(spark, out).collect()] == [2] * 5
    files = {p.suffix for p in (state / "state").rglob("*") if p.is_file()}
    assert files & {".delta", ".zip"} == {kind}

"""What jobs of many steps leave on disk."""

import os
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerbrook import session
from ledgerbrook.operators import intake, inventory
from ledgerbrook.operators.admission import admit
from ledgerbrook.session import SHUFFLES_CONF, cut_lineage, discard, scratch
from ledgerbrook.streaming.chain import Saga
from ledgerbrook.streaming.operators import Dedupe, OnceStockWorker
from ledgerbrook.streaming.runtime import StreamRun

LINES = "unit bigint, res bigint, t bigint, test bigint, add bigint, capacity bigint"


_MADE = []


@pytest.fixture(autouse=True)
def made(monkeypatch):
    """Notes the folders of this session: others may use the shared folder at the same time."""
    written = session.run_dir
    monkeypatch.setattr(session, "run_dir", lambda spark, label: _MADE.append(written(spark, label)) or _MADE[-1])


def _files(spark):
    """Data files of the tables that were cut."""
    return {str(p) for made in _MADE for p in Path(made.removeprefix("file:")).rglob("part-*")}


def _shuffles(spark):
    """Shuffle files of the local session."""
    folder = Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    return {p.name for p in folder.rglob("shuffle_*.data")}


@pytest.fixture
def lines(spark):
    rows = [(n, r, n, 1 + n % 3, 1 + n % 3, 200) for n in range(2000) for r in (n % 7, 7 + n % 11)]
    return spark.createDataFrame(rows, LINES)


@pytest.mark.parametrize("large", [2_000_000, 100])
def test_admission_leaves_its_verdicts_only(spark, monkeypatch, lines, large):
    """States of the rounds and their shuffles go, though nobody collects the plans of the driver."""
    monkeypatch.setattr("ledgerbrook.operators.admission.SMALL", 10)
    monkeypatch.setattr("ledgerbrook.operators.admission.LARGE", large)
    files, shuffles = _files(spark), _shuffles(spark)
    got = admit(lines, "unit", "res", ["t", "unit"])
    left = _files(spark) - files
    assert {Path(p).parent.name.split("-")[0] for p in left} == {"cut"} and len({Path(p).parent for p in left}) == 1
    assert _shuffles(spark) <= shuffles
    taken, expected = {}, {}
    for n in range(2000):
        asks = (n % 7, 7 + n % 11)
        expected[n] = all(taken.get(r, 0) + 1 + n % 3 <= 200 for r in asks)
        for r in asks:
            taken[r] = taken.get(r, 0) + (1 + n % 3 if expected[n] else 0)
    assert {r["unit"]: r["accepted"] for r in got.collect()} == expected


def test_tables_go_with_their_block(spark):
    before, known = spark.conf.get(SHUFFLES_CONF, None), _files(spark)
    with scratch(spark) as hand_on:
        outer = cut_lineage(spark.range(5).where("id > 1"))
        with pytest.raises(ZeroDivisionError), scratch(spark):
            cut_lineage(spark.range(7))
            1 / 0
        with scratch(spark) as inner:
            handed = inner(cut_lineage(outer.select((F.col("id") * 2).alias("id"))))
        assert spark.conf.get(SHUFFLES_CONF) == "true"
        assert len({os.path.dirname(p) for p in _files(spark) - known}) == 2
        result = hand_on(handed.union(outer))
        discard(outer)
        assert len({os.path.dirname(p) for p in _files(spark) - known}) == 2
    assert spark.conf.get(SHUFFLES_CONF, None) == before
    assert sorted(r["id"] for r in result.collect()) == [2, 3, 4, 4, 6, 8]
    assert len({os.path.dirname(p) for p in _files(spark) - known}) == 1


def test_blocks_of_two_threads_do_not_meet(spark):
    """A block that ends takes no table of a block that is open in another thread."""
    opened, ended, got = threading.Event(), threading.Event(), []

    def other():
        with scratch(spark):
            kept = cut_lineage(spark.range(3))
            opened.set()
            ended.wait(60)
            got.append(kept.count())

    thread = threading.Thread(target=other)
    before = spark.conf.get(SHUFFLES_CONF, None)
    with scratch(spark):
        thread.start()
        assert opened.wait(60)
        cut_lineage(spark.range(4))
    assert spark.conf.get(SHUFFLES_CONF) == "true"
    ended.set()
    thread.join()
    assert got == [3] and spark.conf.get(SHUFFLES_CONF, None) == before


def _tables(files):
    return {os.path.dirname(p) for p in files}


@pytest.mark.parametrize("taker", [intake.take_orders, intake.order_outcomes])
def test_intake_leaves_its_outcomes_only(spark, taker):
    """Checks, priced lines, verdicts and errors go with the shuffles behind them."""
    requests = spark.createDataFrame([(n, n % 9, f"k{n % 4}", n) for n in range(60)], "request_id bigint, customer_id bigint, idempotency_key string, arrival bigint")
    items = spark.createDataFrame([(n, p, 1 + n % 3) for n in range(60) for p in (1, 2 + n % 3)], "request_id bigint, product_id bigint, quantity bigint")
    products = spark.createDataFrame([(p, 1.0, 40) for p in range(1, 4)], "id bigint, price double, quantity bigint")
    files, shuffles = _files(spark), _shuffles(spark)
    got = taker(requests, items, products)
    assert len(_tables(_files(spark) - files)) == 1 and _shuffles(spark) <= shuffles
    assert {r["outcome"] for r in got.collect()} == {"CREATED", "REPLAYED", "FAILED"} and got.count() == 60


def test_reserving_leaves_its_answers_only(spark):
    items = spark.createDataFrame([(n, n, k, 1 + (n + k) % 3, 2) for n in range(60) for k in range(2)], "event_key bigint, arrival bigint, pos bigint, product_id bigint, quantity bigint")
    stock = spark.createDataFrame([(1, 40, 0), (2, 30, 0)], "product_id bigint, quantity bigint, reserved_quantity bigint")
    files, shuffles = _files(spark), _shuffles(spark)
    got = inventory.reserve(items, stock)
    assert len(_tables(_files(spark) - files)) == 1 and _shuffles(spark) <= shuffles
    rows = got.collect()
    assert len(rows) == 60 and all((r["reason"] is None) == r["accepted"] for r in rows)


def _outputs(run):
    folder = Path(run.out.removeprefix("file:"))
    return {p.relative_to(folder).parts[0] for p in folder.rglob("*.parquet")}, Path(run.source.removeprefix("file:")).exists()


def test_streams_leave_what_manifests_name(spark):
    """What arrived goes when its batch is done; a start from the checkpoint does not look for it."""
    schema = "event_id string, event_type string, s bigint, order_id bigint, items array<struct<product_id: bigint, quantity: bigint>>"
    of = lambda *rows: spark.createDataFrame(list(rows), schema).withColumn("occurred_at", F.timestamp_seconds("s"))
    slices = [of(("a", "OrderCreated", 1, 1, [(1, 3)])), of(("a", "OrderCreated", 2, 1, [(1, 3)]), ("b", "OrderCreated", 3, 2, [(1, 3)])), of(("c", "PaymentFailed", 4, 1, None))]
    files, shuffles = _files(spark), _shuffles(spark)
    run = StreamRun(spark, "test-disk-stock")
    worker = OnceStockWorker(run, spark.createDataFrame([(1, 5, 0)], OnceStockWorker.STOCK))
    run.replay(slices, lambda rows: rows.writeStream.foreachBatch(worker))
    assert _outputs(run) == ({"seen", "stock", "held", "emitted"}, False)
    told = sorted(run.kept(worker.EMITTED, "emitted").collect(), key=lambda r: r["batch"])
    assert [r["emitted"] for r in told] == ["InventoryReserved", "InventoryRejected", "InventoryReleased"]
    once = StreamRun(spark, "test-disk-dedupe")
    effect = Dedupe(once, "any", ["occurred_at"], lambda fresh: fresh.select("event_id", "order_id"))
    once.replay(slices, lambda rows: rows.writeStream.foreachBatch(effect))
    assert _outputs(once) == ({"seen", "fresh", "changes"}, False)
    assert sorted(r["event_id"] for r in once.kept("event_id string").collect()) == ["a", "b", "c"]
    assert not [p for p in _files(spark) - files if "/cut-" in p] and _shuffles(spark) <= shuffles


def test_stages_keep_refused_bodies_only(spark):
    saga = Saga(spark, spark.createDataFrame([(1, 5, 0)], "product_id bigint, quantity bigint, reserved_quantity bigint"))
    rows = [(1, 10, 5.0, [(1, 3)]), (2, 20, 5.0, [(1, 3)])]
    orders = spark.createDataFrame(rows, "order_id bigint, s bigint, total_amount double, items array<struct<product_id: bigint, quantity: bigint>>")
    saga.replay([orders.withColumn("occurred_at", F.timestamp_seconds("s")).drop("s")])
    names, source = _outputs(saga.stock.run)
    assert "arrived" not in names and not source and _outputs(saga.orders.run) == ({"topics"}, False)
    assert saga.stock.quarantine().count() == 0
    assert {r["order_id"]: r["status"] for r in saga.outcomes().collect()} == {1: "CONFIRMED", 2: "CANCELLED"}

"""Keep-last with keyed state: equal to the batch operator, late rows counted, replays harmless."""
import datetime as dt
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from branchlens.operators.incremental import keep_last
from branchlens.schemas import PAYMENT
from branchlens.streaming import keyed_state as K

KEYS = ["payment_id", "branch"]
DAY0 = dt.datetime(2024, 3, 1)


def deliver(spark, folder, n, rows, day, seq):
    """rows: (id, amount, created day). One landed file."""
    data = [(i, Decimal(a), DAY0 + dt.timedelta(days=d), "m", None, "A" if i else None) for i, a, d in rows]
    df = spark.createDataFrame(data, PAYMENT).withColumns({
        "seq": F.lit(seq).cast("long"), "delivered_at": F.lit(DAY0 + dt.timedelta(days=day)).cast("timestamp")})
    df.coalesce(1).write.mode("append").parquet(f"{folder}/batch={n}")


def test_stream_equals_keep_last_and_counts_late_rows(spark):
    root = tempfile.mkdtemp(prefix="branchlens-keyed-")
    run = lambda: K.run_keyed_stream(spark, f"{root}/in", PAYMENT, f"{root}/t", KEYS, "seq", root, keep="5 days",
                                     files_per_trigger=1)
    store = K.change_store(spark, f"{root}/t", PAYMENT, "seq")
    content = lambda: sorted((r.payment_id or "", int(r.amount), r.month) for r in K.current_rows(store, KEYS, "seq").collect())

    deliver(spark, f"{root}/in", 0, [("1", 10, 0), ("2", 20, 0), ("1", 11, 0), (None, 5, 0)], 0, 1)
    deliver(spark, f"{root}/in", 1, [("1", 12, 40), ("3", 30, 1)], 2, 2)  # 1 moves to the next month
    assert K.late_rows(run()) == 0
    assert [r for r in content() if r[0] in ("", "1", "3")] == [("", 5, "2024-03"), ("1", 12, "2024-04"), ("3", 30, "2024-03")]
    # an older delivery of a known key is not written; one behind the watermark is counted
    before = store.read("changes").count()
    deliver(spark, f"{root}/in", 2, [("1", 99, 0)], 2, 1)
    deliver(spark, f"{root}/in", 3, [("9", 90, 0)], -30, 3)
    assert K.late_rows(run()) == 1
    assert store.read("changes").count() == before and "9" not in [r[0] for r in content()]
    # much later the keys are forgotten; they come back as new ones, and the last still wins
    deliver(spark, f"{root}/in", 4, [("7", 70, 90)], 60, 4)
    deliver(spark, f"{root}/in", 5, [("8", 80, 90)], 61, 5)
    run()
    deliver(spark, f"{root}/in", 6, [("1", 13, 40)], 62, 1)
    deliver(spark, f"{root}/in", 7, [("2", 21, 0)], 62, 9)
    run()
    got = content()
    assert ("1", 12, "2024-04") in got and ("2", 21, "2024-03") in got and len(got) == 6
    K.compact(store, KEYS, "seq")
    assert content() == got and store.read("changes").count() == 6


def test_query_equals_the_batch_operator(spark, sf_dir):
    from branchlens.plans.catalog import QUERIES
    a, b = QUERIES["stream_keyed_state"](spark, sf_dir), QUERIES["dedupe_payments"](spark, sf_dir)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert keep_last(a, KEYS, ["payment_id"]).count() == a.count()


def test_state_is_called_by_buckets_not_by_keys():
    """A bucket of 5000 keys takes one read, one update and one timer; expired keys leave, and the
    timer of the others is set again."""
    from types import SimpleNamespace as N

    class State:
        value, calls = None, 0

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

        def clear(self):
            self.value = None

    state, timers = State(), []
    p = K.LastDelivery(["payment_id"], "seq", 100)
    p.init(N(getValueState=lambda *_: state, registerTimer=timers.append))
    rows = lambda n, seq: iter([{"_key": str(i), "payment_id": str(i), "seq": seq} for i in range(n)])
    at = lambda ms: N(getCurrentWatermarkInMs=lambda: ms)
    assert len(list(p.handleInputRows((0,), rows(5000, 1), at(0)))) == 5000
    assert state.calls == 2 and timers == [100]
    assert len(list(p.handleInputRows((0,), rows(3, 2), at(50)))) == 3 and list(p.handleInputRows((0,), rows(9, 1), at(50))) == []
    assert timers == [100]
    list(p.handleExpiredTimer((0,), at(100), None))
    assert sorted(state.value[0]) == ["0", "1", "2"] and timers == [100, 150]
    list(p.handleExpiredTimer((0,), at(150), None))
    assert state.value is None

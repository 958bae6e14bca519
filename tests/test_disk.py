"""What the jobs made of writes have on the disks: shuffle files of one step, rewrites in slices, no used scratch."""
import os
import random
import tempfile
import time

import pytest
from test_delta_marts import delivery, full_refresh
from test_ingest import counts, landing

from branchlens.plans import ingest, raw_queries
from branchlens.plans.delta_marts import DeltaMarts
from branchlens.session import shuffles_freed
from branchlens.sources import snapshots as S


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def left(spark, before):
    """Shuffle files that were not there before; they are deleted by messages, so a little later."""
    until = time.time() + 20
    while (now := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return now


@pytest.fixture
def own_scratch(spark, monkeypatch, tmp_path):
    made = []

    def scratch_path(_, name):
        made.append(f"{tmp_path}/{name}-{len(made)}")
        return made[-1]
    for module in (ingest, raw_queries):
        monkeypatch.setattr(module, "scratch_path", scratch_path)
    return made


def test_the_setting_ends_with_the_job(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with pytest.raises(ZeroDivisionError), shuffles_freed(spark), shuffles_freed(spark):
        assert spark.conf.get(key) == "true"
        1 / 0
    assert spark.conf.get(key, None) == before


# ---------------------------------------------------------------- F1: marts_incremental

def test_the_steps_of_the_marts_leave_no_shuffle_files(spark):
    rng, root, before = random.Random(4), tempfile.mkdtemp(prefix="branchlens-disk-"), shuffle_files(spark)
    raw = ingest.raw_store(spark, f"{root}/raw")
    marts = DeltaMarts(spark, f"{root}/marts", raw)
    for seq, ids in enumerate((range(20), range(10, 30))):
        raw_queries.deliver(raw, delivery(spark, rng, ids, f"names {seq}"), seq, f"{root}/b{seq}")
        marts.refresh()
        assert not os.path.exists(f"{root}/b{seq}")  # the rows are in the store
    assert not left(spark, before)


def test_marts_in_slices_equal_a_full_refresh(spark, monkeypatch):
    """Sales that come again in other months leave lines behind in the month they had."""
    monkeypatch.setattr(S, "SLICE_BYTES", 1)
    rng, root = random.Random(5), tempfile.mkdtemp(prefix="branchlens-groups-")
    raw = ingest.raw_store(spark, f"{root}/raw")
    marts = DeltaMarts(spark, f"{root}/marts", raw)
    for seq, batch in enumerate((delivery(spark, rng, range(20), "first"), delivery(spark, rng, range(12, 30), "a second and longer"))):
        raw_queries.deliver(raw, batch, seq, f"{root}/b{seq}")
        assert S.slice_count(raw.read("lines")) == S.SLICES
        marts.refresh()
        rows = lambda m: sorted(map(str, raw_queries.mart_rows(m).collect()))
        assert rows(marts.marts()) == rows(full_refresh(raw)), seq


def test_slices_hold_every_row_once_and_a_key_in_one(spark):
    rows = [(k, b, n) for n, k in enumerate(["1", "2", None, "4", "1"] * 8) for b in ("A", None)]
    df = spark.createDataFrame(rows, "k string, b string, n int")
    parts = [part.collect() for part in S.sliced(df, ["k", "b"], 3)]
    assert sorted(map(str, (tuple(r) for p in parts for r in p))) == sorted(map(str, rows))
    keys = [{(r.k, r.b) for r in p} for p in parts]
    assert sum(map(len, keys)) == len(set.union(*keys)) == 8
    assert S.slice_count(df) == 1  # no files


def test_a_merge_in_slices_equals_one_in_one_piece(spark, monkeypatch):
    rng, found = random.Random(7), []
    key = lambda: rng.choice([None, *map(str, range(30))])
    schema = "k string, v long, seq long, month string"
    batches = [[(key(), n, seq, rng.choice([None, "2024-01", "2024-02", "2024-03"])) for n in range(60)] for seq in (0, 1, 2)]
    for slice_bytes in (1, 1 << 40):
        monkeypatch.setattr(S, "SLICE_BYTES", slice_bytes)
        root = tempfile.mkdtemp(prefix="branchlens-slices-")
        store = S.SnapshotStore(spark, root, {"t": (spark.createDataFrame([], schema).schema, "month")})
        for seq, rows in enumerate(batches):
            at, df = store.snapshot(), spark.createDataFrame(rows, schema)
            change = store.merge("t", df, ["k"], ["seq", "v"], at, also=[None, "2024-01", "2024-02", "2024-03"])
            assert seq == 0 or S.slice_count(store.read("t")) == (S.SLICES if slice_bytes == 1 else 1)
            store.commit(at, {"t": change})
        found.append(sorted(map(str, store.read("t").collect())))
    last = {}
    for rows in batches:
        for row in sorted(rows, key=lambda r: r[1:3]):
            last[row[0]] = row
    assert found[0] == found[1] and len(found[0]) == len(last)


# ---------------------------------------------------------------- F2, F3: incremental_upsert, upsert_raw_rows

def test_two_landings_leave_the_raw_tables_only(spark, sf_dir, own_scratch):
    """Landings, parsed pages, delivered entities and earlier versions are gone when nothing reads them."""
    from branchlens.plans.catalog import Inputs
    before = shuffle_files(spark)
    rows = raw_queries.upsert_raw_rows(Inputs(spark, sf_dir))
    assert not left(spark, before)
    root, = [p for p in own_scratch if "/incremental-" in p]
    assert os.listdir(root) == ["raw"] and not any(os.path.exists(p) for p in own_scratch if p != root)
    store = ingest.raw_store(spark, f"{root}/raw")
    used = {(t, f"commit={c}") for t, parts in store.snapshot().tables.items() for cs in parts.values() for c in cs}
    assert {(t, c) for t in os.listdir(f"{root}/raw/data") for c in os.listdir(f"{root}/raw/data/{t}")} == used
    assert rows.count() == sum(store.read(t).count() for t in ("sales", "lines", "payments", "products"))


def test_ingest_in_slices_equals_ingest_in_one_piece(spark, monkeypatch):
    found = []
    for slice_bytes in (1, 1 << 40):
        monkeypatch.setattr(S, "SLICE_BYTES", slice_bytes)
        root = tempfile.mkdtemp(prefix="branchlens-slices-")
        landing(f"{root}/l0", 100)
        landing(f"{root}/l0", 60, "02", extra=['{"data": [{"id": "900"}], "included": [{"relationships": {"product": {"data": {"id": "7"}}}}]}'])
        landing(f"{root}/l1", 300)
        landing(f"{root}/l1", 90, "02")
        first = ingest.bootstrap(spark, f"{root}/l0", f"{root}/raw")
        then = ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)
        rows = raw_queries.raw_rows(ingest.raw_store(spark, f"{root}/raw").read).collect()
        found.append((first, then, counts(spark, f"{root}/raw"), sorted(map(str, rows))))
    assert found[0] == found[1]
    assert found[0][0]["lines"] == 161 and found[0][0]["sales"] == 161 and found[0][1]["lines"] > 0


def test_lines_below_the_marks_are_not_shuffled(spark, monkeypatch):
    """The items of old sales are left out before they are joined with the sales that were selected."""
    root, seen = tempfile.mkdtemp(prefix="branchlens-marks-"), []
    select = ingest.I.select_after_marks
    monkeypatch.setattr(ingest.I, "select_after_marks",
                        lambda feed, marks, id_col: seen.append(feed.columns) or select(feed, marks, id_col))
    landing(f"{root}/l0", 100)
    landing(f"{root}/l1", 130)
    ingest.bootstrap(spark, f"{root}/l0", f"{root}/raw")
    got = ingest.incremental(spark, f"{root}/l1", f"{root}/raw", 1)
    assert got["lines"] == got["sales"] == 50
    assert any("product_id" in columns and "price" in columns for columns in seen)

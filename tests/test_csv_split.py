"""CSV records across read splits equal the one-task reader."""
import os
import random
import tempfile

import pandas as pd
import pytest

from branchlens.sources import csv_split as S
from branchlens.sources import readers


@pytest.fixture
def tiny_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(keep, (str(n), "1"))]
    for k, v in keep.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(map(str, df.collect()))


def text(rng):
    return "".join(rng.choice(['"', '""', "\n", ",", "a", "b\n\nc", "é", " ", "x" * 30, "'"]) for _ in range(rng.randint(0, 12)))


@pytest.mark.parametrize("seed,size", [(1, 37), (2, 64), (3, 500), (4, 100_000)])
def test_random_cells_equal_the_one_task_reader(spark, tiny_splits, seed, size, monkeypatch):
    rng, folder = random.Random(seed), tempfile.mkdtemp(prefix="branchlens-csv-")
    for n in range(3):
        pd.DataFrame({"id": range(40), "a": [text(rng) for _ in range(40)], "b": [text(rng) for _ in range(40)]}) \
            .to_csv(os.path.join(folder, f"f{n}.csv"), index=False, lineterminator=rng.choice(["\n", "\n"]))
    want = rows(readers._csv(spark, folder))
    assert len(want) == 120
    tiny_splits(size)
    if seed == 1:
        monkeypatch.setattr(S, "MAX_BROADCAST", 0)  # the way of very many splits
    got = readers._csv(spark, folder, split=True)
    assert rows(got) == want
    if size < 1000:
        assert S._lines(spark, folder).select("file", "block").distinct().count() > 10


def test_cell_larger_than_many_splits_and_carriage_returns(spark, tiny_splits):
    folder = tempfile.mkdtemp(prefix="branchlens-csv-")
    with open(os.path.join(folder, "f.csv"), "w", newline="") as f:
        f.write('id,a\r\n1,"' + "line ""two""\n" * 200 + '"\r\n\r\n2,id\r\nid,a\r\n3,"x, y"')
    tiny_splits(50)
    got = readers._csv(spark, folder, split=True).collect()
    assert sorted((r.id, len(r.a)) for r in got) == [("1", 200 * 9), ("2", 2), ("3", 4), ("id", 1)]


def test_headers_and_empty_folder(spark):
    folder = tempfile.mkdtemp(prefix="branchlens-csv-")
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write('id,"the, name"\n')
    df = readers._csv(spark, folder, split=True)
    assert df.columns == ["id", "the, name"] and df.count() == 0
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write("id,other\n1,2\n")
    with pytest.raises(ValueError):
        readers._csv(spark, folder, split=True)

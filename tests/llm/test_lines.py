import random

import pytest

from branchlens.llm import line_winnow as L
from branchlens.llm.queries import op7_lines
from branchlens.llm.tables import table

ENDS = " \t\x0b\x0c\r"


def brute(rows, run):
    """rows: (id, text). Text and counts after deleting later repeats of ``run`` lines."""
    seqs = {i: [(n, x.strip(ENDS)) for n, x in enumerate(t.split("\n")) if x.strip(ENDS)] for i, t in rows if t is not None}
    first = {}
    for i in sorted(seqs):
        for p in range(len(seqs[i]) - run + 1):
            first.setdefault(tuple(x for _, x in seqs[i][p: p + run]), (i, p))
    for i, t in rows:
        gone = set()
        for p in range(len(seqs.get(i, [])) - run + 1):
            j, q = first[tuple(x for _, x in seqs[i][p: p + run])]
            if j != i or q + run <= p:
                gone.update(n for n, _ in seqs[i][p: p + run])
        text = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
        yield i, text, len(seqs.get(i, [])), len(gone)


@pytest.mark.parametrize("run", [1, 2, 3])
def test_random_documents_equal_brute_force(spark, run):
    rng = random.Random(run)
    rows = [(i, "\n".join(rng.choice(["a", "b", " c ", "", "d d", "e\r"]) for _ in range(rng.randint(0, 14))))
            for i in range(60)]
    got = L.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), run=run).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, run))


def test_op7_on_the_table(spark, sf_dir):
    import hashlib
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    want = sorted((i, n, k, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, n, k in brute(rows, L.RUN))
    assert sorted(map(tuple, op7_lines(spark, sf_dir).collect())) == want


def test_edges(spark):
    long = "\n".join(f"line {i}" for i in range(50_000))
    rows = [(1, "x\ny\nz", 7, "u"), (1, "x\ny\nz", 7, "u"), (2, None, 8, "v"), (3, "", 9, "w"), (4, " \n\t\n", 1, "w"),
            (5, long, 2, "w"), (6, "keep\nline 1\n\nline 2\nend", 3, "w"), (None, "x\ny", 4, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, h string")
    out = L.drop_repeated_lines(df).collect()
    got = sorted(((r.doc_id or 0, r.text, r.n_lines, r.n_removed, r.h) for r in out), key=str)
    # a null id is the smallest: it keeps "x y", both copies of id 1 lose it, equal rows share one fate
    assert got == sorted([(0, "x\ny", 2, 0, "w"), (1, "z", 3, 2, "u"), (1, "z", 3, 2, "u"), (2, None, 0, 0, "v"),
                          (3, "", 0, 0, "w"), (4, " \n\t\n", 0, 0, "w"), (5, long, 50_000, 0, "w"),
                          (6, "keep\n\nend", 4, 2, "w")], key=str)
    assert L.drop_repeated_lines(df.limit(0)).collect() == []

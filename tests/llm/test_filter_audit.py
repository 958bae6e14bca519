import random
import re
from itertools import permutations

from branchlens.llm import filter_audit as A
from branchlens.llm.queries import op13_audit
from branchlens.llm.tables import table

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """docs: (id, text, source); labels: (id, quality, toxic). Runs every order over every document."""
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    rows = {}
    for i, t, source in docs:
        t = t or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails = {f for f, bad in (("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                                  ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)), ("D", re.search(r"[#$%&*|]", t)),
                                  ("E", i is not None and t in least and i > least[t])) if bad}
        rows.setdefault(source or "", []).append((i, fails))
    out = []
    for part, members in rows.items():
        steps, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = members
            for n, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                shapley[f] += len(gone)
                steps.append((part, order, n, len(left), len(gone), sum(f in m[1] for m in members) - len(gone),
                              sum(m[1] == {f} for m in members), sum(m[0] in good for m in gone),
                              sum(m[0] in toxic for m in gone), f))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def run(spark, docs, labels):
    d = spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in docs], "doc_id long, text string, source string, mask int, part string")
    m = spark.createDataFrame([(*r, 9) for r in labels], "doc_id long, quality int, toxic int, good int")
    return sorted(tuple(r[c] for c in COLUMNS) for r in A.audit(A.masks(d, m)).collect())


def test_intervals_tell_the_first_failing_step_of_every_order():
    orders = list(permutations(range(5)))
    for mask in range(32):
        found = {}
        for m, step, lo, hi in A.removal_intervals():
            if m == mask:
                assert not any(r in found for r in range(lo, hi))
                found.update((r, step) for r in range(lo, hi))
        want = {r: next(n for n, f in enumerate(o, 1) if mask >> f & 1) for r, o in enumerate(orders)} if mask else {}
        assert found == want


def test_random_documents_equal_brute_force(spark):
    rng = random.Random(5)

    def text():
        words = [rng.choice(["a", "b", "Cap", "x$", "é"]) if rng.random() < 0.5 else f"w{rng.randint(0, 400)}"
                 for _ in range(rng.choice([0, 5, 199, 200, 260]))]
        return rng.choice([" ", "\n", "\x0b "]).join(words)

    texts = [text() for _ in range(25)]
    docs = [(i, rng.choice(texts), rng.choice(["p", "q", "r"])) for i in range(60)]
    labels = [(rng.randint(0, 70), rng.randint(0, 1), rng.randint(0, 1)) for _ in range(50)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    docs = [(1, "same", None), (1, "same", ""), (2, "same", "s"), (None, "same", "s"), (None, None, "s"), (7, "", "s"),
            (8, None, "s"), (9, long, "s"), (10, long, "t"), (11, " " * 3, "t"), (12, "A" * 50, "t")]
    labels = [(2, 1, 0), (2, 0, 1), (None, 1, 1), (10, None, 1), (99, 1, 1)]
    assert run(spark, docs, labels) == brute(docs, labels)
    assert run(spark, [], labels) == []
    assert run(spark, docs, []) == brute(docs, [])


def test_op13_on_the_table(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.source) for r in table(spark, sf_dir, "documents").collect()]
    labels = [tuple(r) for r in table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic").collect()]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in op13_audit(spark, sf_dir).collect())
    assert got == brute(docs, labels)

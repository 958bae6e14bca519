import hashlib
import itertools
import random
import re
import zlib

import pytest

from branchlens.llm import conversation_repair as C
from branchlens.llm.queries import op12_conversations
from branchlens.llm.tables import table

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
PATTERN = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def hurt(rows):
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (c, t))
        kind = zlib.crc32(key.encode()) % 20
        if kind:
            row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            yield from [row, row] if kind == 3 else [row]


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows, faults):
    """Every choice of edits with at most two insertions at a place: cost, audit, lines."""
    per_row = []
    for (_, _, role, text), fault in zip(rows, faults):
        late = 3 if fault == "truncated" else 0
        choices = [(4, "D", None)]
        if fault not in ("blank", "duplicate"):
            choices += [(late, "K", (role, text))] + [(3 + late, "R", (r, text)) for r in ("user", "assistant") if r != role]
        per_row.append(choices)
    places = [(3 * n, "I" * n, c) for n in range(3) for c in itertools.product(("user", "assistant"), repeat=n)]
    slots = [x for row in per_row for x in (places, row)] + [places]
    for chosen in itertools.product(*slots):
        lines = []
        for x in chosen:
            lines += [(r, "") for r in x[2]] if x in places else [x[2]] if x[2] else []
        if PATTERN.fullmatch("".join(r[:1] or "-" for r, _ in lines)):
            yield sum(x[0] for x in chosen), "".join(x[1] for x in chosen), "\n".join(f"{r}:{t}" for r, t in lines)


def by_states(rows, faults):
    """The same minimum by a plain walk over strings, for conversations of any length."""
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    full = {"u": "user", "a": "assistant"}

    def with_inserts(now):
        out = dict(now)
        for _ in range(2):
            for q, (cost, audit, lines) in list(out.items()):
                for r, to in moves[q].items():
                    if r != "s":
                        out[to] = min(out.get(to, (10 ** 9,)), (cost + 3, audit + "I", lines + ((full[r], ""),)))
        return out

    now = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for q, (cost, audit, lines) in with_inserts(now).items():
            options = [(q, 4, "D", ())]
            if fault not in ("blank", "duplicate"):
                late = 3 if fault == "truncated" else 0
                for r, to in moves[q].items():
                    if role[:1] == r:
                        options.append((to, late, "K", ((role, text),)))
                    elif r != "s":
                        options.append((to, 3 + late, "R", ((full[r], text),)))
            for to, c, letter, line in options:
                after[to] = min(after.get(to, (10 ** 9,)), (cost + c, audit + letter, lines + line))
        now = after
    cost, audit, lines = min(v for q, v in with_inserts(now).items() if q in ("", "a"))
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)


def brute(rows, best=by_states):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(hurt([r for r in rows if r[0] == conv]),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults, turns = faults_of(mine), [r[1] for r in mine if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        cost, audit, text = best(mine, faults)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *[faults.count(x) for x in ("blank", "duplicate", "truncated")],
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "conv_id long, turn long, role string, text string, part int, seg int")
    return sorted((tuple(r[c] for c in COLUMNS) for r in C.repair_report(df, C.damage(df)).collect()), key=str)


def invented(rng, convs, longest):
    roles = ["user", "assistant", "system", "tool", None, "", "umpire"]
    texts = ["a b.", "cut off", "", " \n", "Why?", "é!", None, "so", "x\ty. "]
    return [(c, rng.choice([t, t, t + 1, None]), rng.choices(roles, [9, 9, 2, 1, 1, 1, 1])[0], rng.choice(texts))
            for c in range(convs) for t in range(rng.randint(1, longest))]


def test_the_walk_of_states_is_the_minimum_over_all_edits():
    rng = random.Random(2)
    for n in range(60):
        rows = invented(rng, 1, 3)[:3]
        rows = sorted(hurt(rows), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))[:3]
        faults = faults_of(rows)
        assert min(all_edits(rows, faults)) == by_states(rows, faults)


@pytest.mark.parametrize("cut", [1, 2, 256])
def test_random_conversations_equal_brute_force(spark, cut):
    """However small the segments are, the result is the same."""
    rows = invented(random.Random(cut), 60, 12)
    assert run_with_cut(spark, rows, cut) == brute(rows)


def run_with_cut(spark, rows, cut):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segs = C.segments(C.damage(df), segment_rows=cut)
    assert segs.agg({"n": "max"}).first()[0] <= cut
    return sorted((tuple(r[c] for c in COLUMNS) for r in C.report_of(df, segs).collect()), key=str)


def test_one_conversation_over_many_tasks(spark):
    """A conversation that is nearly the whole table is cut over the range partitions."""
    rng = random.Random(9)
    rows = [(5, t, rng.choice(["user", "assistant", "system"]), f"{rng.choice('abc')} {t % 97}{rng.choice(['.', ''])}")
            for t in range(3000)] + [(6, 0, "user", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little would be one task
    try:
        segs = C.segments(C.damage(df), segment_rows=64)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert segs.where("conv_id = 5").select("part").distinct().count() > 1
    got = sorted(tuple(r[c] for c in COLUMNS) for r in C.report_of(df, segs).collect())
    assert got == brute(rows)


def test_edges(spark):
    rows = [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (1, None, None, None), (2, 5, "user", "x" * 300_000 + "."),
            (2, 6, "assistant", "y."), (3, 1, "user", "same."), (3, 1, "user", "same."), (4, 2, "assistant", "only.")]
    rows += [(100 + c, 0, "user", "q?") for c in range(60)]  # some of them lose their only row
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_repaired_rows_follow_the_pattern(spark):
    rows = invented(random.Random(4), 40, 9)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segs = C.segments(C.damage(df))
    fixed = C.repaired_rows(segs, C.decisions(segs)).orderBy("conv_id", "part", "seg", "pos").collect()
    for conv, lines in itertools.groupby(fixed, key=lambda r: r.conv_id):
        assert PATTERN.fullmatch("".join(r.role[:1] for r in lines))


def test_op12_on_the_table(spark, sf_dir):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, sf_dir, "conversations").collect()]
    got = sorted((tuple(r[c] for c in COLUMNS) for r in op12_conversations(spark, sf_dir).collect()), key=str)
    assert got == brute(rows)

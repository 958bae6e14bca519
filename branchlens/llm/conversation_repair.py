"""Conversation structure repair by scalar big-integer weights.

A conversation is its rows by turn. Its role initials should read ``(s?(ua)+)?``: an optional
system row, then user and assistant in turn. The cheapest edits that make it so are found
by one shortest path over the rows and the four states of that pattern, and the weight of
a path is one integer: its high digits are the cost, below them every row has a slot of
two octal digits that spell its edits (D, I, K, R = 1 to 4 in ASCII order; an insertion
before the row's own letter; one letter is padded with a zero at its end), and a last slot
stands for an insertion at the end. Slots are spelt by the code words D K R ID IK IR, none
of which begins another, so comparing padded slots is comparing the spelt strings. The
smaller integer is thus the cheaper path, and of equal costs the ASCII-least audit; adding
and taking the minimum decides everything. Two insertions in a row never pay: they lead
back to the same state, or to the end after a lone system row, which costs 6 where
deleting that row costs 4.

Faults of a row, the first one counts: *blank* (only white space; must go), *duplicate*
(role and text were seen earlier; must go), *truncated* (its last character that is not
white space does not end a sentence; 3 unless deleted). Keep 0, Rerole 3, Delete 4, Insert 3.

Scale: rows are dealt by ranges of (conversation, turn, role, text), so that a conversation
that holds a third of all rows lies in many tasks. A task cuts its rows into segments of at
most ``SEGMENT_ROWS`` rows and gives the cheapest weight from every state to every state of
the segment. The segments of a conversation are multiplied (minimum for sum, addition for
product) without their texts: 12 bytes a row. The decisions go back to the segments by
their number, and texts are edited there. SHA-256 is sequential, so the pieces of one
conversation are hashed in order by one task, which streams them.

Edge cases: null roles, texts and numbers are one space; a null conversation id is a
conversation; rows of one turn are ordered by role, then text (bytes); initials are first
characters, so any role that begins with s, u or a is read as that one; conversations
without rows after the damage have zeros, an empty audit and the hash of the empty string;
an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .tables import bound_batches, materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SEGMENT_ROWS, SEGMENT_BYTES = 256, 64 << 10
START, S, U, A = range(4)
_LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
_SPELT = str.maketrans({"0": None, "1": "D", "2": "I", "3": "K", "4": "R"})
_SLOT = 6  # bits of two octal digits
_ROLE = {U: "user", A: "assistant"}
_SPACE = " \t\n\x0b\x0c\r"


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage by crc32(``conv_id:turn``) % 20: 0 drops a row, 1 empties its
    text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    def filled(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"),
                                kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def step(state: int, initial: str) -> int | None:
    """The state after a row of that role; None where the pattern forbids it."""
    if initial == "u":
        return U if state != U else None
    if initial == "a":
        return A if state == U else None
    return S if initial == "s" and state == START else None


def inserted(state: int) -> int:
    return A if state == U else U


def row_edges(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, int, int]]:
    """(from, to, cost, slot): the cheapest edits of one row between two states."""
    best = {}
    for state in range(4):
        for here, paid, head in ((state, 0, ""), (inserted(state), INSERT, "I")):
            edits = [("D", here, DELETE)]
            if not must_go:
                late = TRUNCATED if truncated else 0
                edits += [("K", step(here, initial), KEEP + late), ("R", inserted(here), REROLE + late)]
            for letter, to, cost in edits:
                if to is not None:
                    slot = int("".join(str(_LETTERS[x]) for x in head + letter).ljust(2, "0"), 8)
                    best[state, to] = min(best.get((state, to), (1 << 30, 0)), (paid + cost, slot))
    return [(a, b, *w) for (a, b), w in sorted(best.items())]


def cheapest(edges: list[list[tuple]], entries=range(4)) -> list[list[int | None]]:
    """weights[from][to] of the cheapest path over the rows; None where there is none."""
    width, found = _SLOT * len(edges), [[None] * 4 for _ in range(4)]
    for entry in entries:
        now = {entry: 0}
        for n, row in enumerate(edges, 1):
            shift, after = width - _SLOT * n, {}
            for a, b, cost, slot in row:
                if a in now:
                    w = now[a] + (cost << width) + (slot << shift)
                    if b not in after or w < after[b]:
                        after[b] = w
            now = after
        for to, w in now.items():
            found[entry][to] = w
    return found


def _chained(a, n, b, m):
    """The product of the weights of n rows and of the m rows behind them."""
    low, high, out = (1 << _SLOT * m) - 1, _SLOT * (n + m), [[None] * 4 for _ in range(4)]
    for e in range(4):
        for x in range(4):
            out[e][x] = min(((a[e][k] << _SLOT * m) + (b[k][x] & low) + (b[k][x] >> _SLOT * m << high)
                             for k in range(4) if a[e][k] is not None and b[k][x] is not None), default=None)
    return out


def solve(segments: list[tuple[int, list[list[int | None]]]]) -> tuple[int, list[tuple[int, str]], str]:
    """Cost, (entry state, octal slots) of every segment, and audit of a whole conversation
    from (rows, weights) of its segments in order. Neighbours of like length are multiplied
    first, so long conversations take n log n digits."""
    stack = []
    for n, weights in segments:
        stack.append((n, weights))
        while len(stack) > 1 and stack[-2][0] <= 2 * stack[-1][0]:
            (n2, w2), (n1, w1) = stack.pop(), stack.pop()
            stack.append((n1 + n2, _chained(w1, n1, w2, n2)))
    while len(stack) > 1:
        (n2, w2), (n1, w1) = stack.pop(), stack.pop()
        stack.append((n1 + n2, _chained(w1, n1, w2, n2)))
    rows, weights = stack[0]
    width = _SLOT * (rows + 1)
    closing = int("20", 8)  # an insertion behind the last row
    value = min((w << _SLOT) + end for w, end in (
        (weights[START][START], 0), (weights[START][A], 0),
        (weights[START][U], (INSERT << width) + closing)) if w is not None)
    slots = format(value & ((1 << width) - 1), "o").zfill(2 * (rows + 1))
    state, at, parts = START, 0, []
    for n, weights in segments:
        piece = slots[at: at + 2 * n]
        parts.append((state, piece))
        digits, low, at = int(piece, 8), (1 << _SLOT * n) - 1, at + 2 * n
        state = next(x for x in range(4) if weights[state][x] is not None and weights[state][x] & low == digits)
    parts[-1] = (parts[-1][0], parts[-1][1] + slots[at:])
    return value >> width, parts, slots.translate(_SPELT)


def edited(state: int, slots: str, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """The rows of a segment after its edits."""
    out_roles, out_texts = [], []

    def put(role, text):
        out_roles.append(role)
        out_texts.append(text)

    for n in range(len(slots) // 2):
        for letter in slots[2 * n: 2 * n + 2].translate(_SPELT):
            if letter == "K":
                state = step(state, roles[n][:1])
                put(roles[n], texts[n])
            elif letter in "IR":
                state = inserted(state)
                put(_ROLE[state], "" if letter == "I" else texts[n])
    return out_roles, out_texts


_SEGMENT = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seg", pa.int64()), ("n", pa.int64()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first_role", pa.string()),
    ("last_role", pa.string()), ("min_turn", pa.int64()), ("max_turn", pa.int64()), ("turns", pa.int64()),
    ("weights", pa.list_(pa.binary())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
_SEGMENT_DDL = ("conv_id bigint, part int, seg bigint, n bigint, blank bigint, duplicate bigint, truncated bigint, "
                "illegal bigint, first_role string, last_role string, min_turn bigint, max_turn bigint, turns bigint, "
                "weights array<binary>, roles array<string>, texts array<string>")
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _faults(rows: list[tuple]) -> list[str]:
    """The first fault of each (turn, role, text, later, again); '' for a sound row."""
    found = []
    for _, _, text, later, again in rows:
        last = text.rstrip(_SPACE)[-1:]
        found.append("blank" if not last else "duplicate" if later or again
                     else "truncated" if last not in ".!?" else "")
    return found


def _segment(conv, part, seg, fresh, rows, memo):
    faults = _faults(rows)
    initials = [r[1][:1] for r in rows]
    edges = []
    for initial, fault in zip(initials, faults):
        kind = initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated"
        if kind not in memo:
            memo[kind] = row_edges(*kind)
        edges.append(memo[kind])
    weights = cheapest(edges, (START,) if fresh else range(4))
    packed = [None if w is None else w.to_bytes((w.bit_length() + 7) // 8, "big") for line in weights for w in line]
    turns = [r[0] for r in rows if r[0] is not None]
    return (conv, part, seg, len(rows), *[faults.count(x) for x in ("blank", "duplicate", "truncated")],
            sum(pair not in _LEGAL for pair in zip(initials, initials[1:])), initials[0], initials[-1],
            turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), packed,
            [r[1] for r in rows], [r[2] for r in rows])


def _cut(batches, segment_rows):
    """Segments of a task's sorted rows (conv_id, turn, role, text, later)."""
    part, seg, memo, out, held = TaskContext.get().partitionId(), 0, {}, [], 0
    conv, rows, size, fresh, first = None, [], 0, False, True
    before = None
    for b in batches:
        for c, turn, role, text, later in zip(*(col.to_pylist() for col in b.columns)):
            if rows and (c != conv or len(rows) >= segment_rows or size >= SEGMENT_BYTES):
                out.append(_segment(conv, part, seg, fresh, rows, memo))
                seg, held, rows, size, fresh = seg + 1, held + size, [], 0, c != conv
                if held >= 1 << 23 or len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _SEGMENT)], schema=_SEGMENT)
                    out, held = [], 0
            if first:  # the first conversation of a task may have begun in the task before
                fresh, first = part == 0, False
            conv = c
            rows.append((turn, role, text, later, (c, turn, role, text) == before))
            before, size = (c, turn, role, text), size + len(text)
    if rows:
        out.append(_segment(conv, part, seg, fresh, rows, memo))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _SEGMENT)], schema=_SEGMENT)


def segments(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Segments of (conv_id, turn, role, text) rows, written to the shared folder."""
    bound_batches(rows.sparkSession)
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    rows = rows.select("conv_id", "turn", "role", "text", digest.alias("digest"))
    firsts = materialise(rows.groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
                         .where("n > 1").select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "first"),
                         "conversation-repeats")
    same = rows["conv_id"].eqNullSafe(firsts["_conv"]) & (rows["digest"] == firsts["_digest"])
    marked = rows.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "text", F.coalesce(F.struct("turn") > F.col("first"), F.lit(False)).alias("later"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    cut = marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        lambda batches: _cut(batches, segment_rows), _SEGMENT_DDL)
    return materialise(cut, "conversation-segments")


_DECIDED_DDL = ("conv_id bigint, part int, seg bigint, state int, slots string, gaps bigint, blank bigint, "
                "duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


def _decide(batches):
    """Per conversation a report (no part) and the decisions of its segments."""
    schema = None

    def decided(conv, held):
        segs, low, high, turns, illegal, before = [], None, None, 0, 0, None
        for r in held:
            flat = [None if w is None else int.from_bytes(w, "big") for w in r["weights"]]
            segs.append((r["n"], [flat[i: i + 4] for i in (0, 4, 8, 12)]))
            illegal += r["illegal"] + (before is not None and (before, r["first_role"]) not in _LEGAL)
            before = r["last_role"]
            if r["turns"]:
                turns += r["turns"] - (high == r["min_turn"])  # a turn may lie on both sides of a cut
                low, high = r["min_turn"] if low is None else low, r["max_turn"]
        cost, parts, audit = solve(segs)
        gaps = high - low + 1 - turns if turns else 0
        yield (conv, None, None, None, None, gaps, *[sum(r[x] for r in held) for x in ("blank", "duplicate", "truncated")],
               illegal, cost, audit)
        for r, (state, slots) in zip(held, parts):
            yield (conv, r["part"], r["seg"], state, slots, *[None] * 7)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema)], names=[
            x.split()[0] for x in _DECIDED_DDL.split(", ")])

    schema = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6, pa.string()]
    conv, held, out = None, [], []
    for b in batches:
        for r in b.to_pylist():
            if held and r["conv_id"] != conv:
                out += decided(conv, held)
                held = []
                if len(out) >= 1000:
                    yield batch(out)
                    out = []
            conv = r["conv_id"]
            held.append(r)
    if held:
        out += decided(conv, held)
    if out:
        yield batch(out)


def decisions(segs: DataFrame) -> DataFrame:
    """The report of every conversation (part is null) and the edits of every segment."""
    small = segs.drop("roles", "texts")
    return materialise(small.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
                       .mapInArrow(_decide, _DECIDED_DDL), "conversation-decisions")


def _apply(batches):
    for b in batches:
        rows = b.to_pylist()
        done = [edited(r["state"], r["slots"], r["roles"], r["texts"]) for r in rows]
        yield pa.RecordBatch.from_arrays([
            b.column(0), b.column(1), b.column(2), pa.array([x[0] for x in done], pa.list_(pa.string())),
            pa.array([x[1] for x in done], pa.list_(pa.string()))], names=["conv_id", "part", "seg", "roles", "texts"])


def repaired_pieces(segs: DataFrame, decided: DataFrame) -> DataFrame:
    """(conv_id, part, seg, roles, texts): the repaired rows; pieces of a conversation follow
    each other by (part, seg)."""
    edits = decided.where("part IS NOT NULL").select("part", "seg", "state", "slots")
    joined = segs.select("conv_id", "part", "seg", "roles", "texts").join(edits, ["part", "seg"])
    return joined.select("conv_id", "part", "seg", "roles", "texts", "state", "slots").mapInArrow(
        _apply, "conv_id bigint, part int, seg bigint, roles array<string>, texts array<string>")


def repaired_rows(segs: DataFrame, decided: DataFrame) -> DataFrame:
    """(conv_id, part, seg, pos, role, text) of every repaired row, in that order."""
    both = F.posexplode(F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text")))
    return repaired_pieces(segs, decided).select("conv_id", "part", "seg", both.alias("pos", "x")).select(
        "conv_id", "part", "seg", "pos", "x.role", "x.text")


def _hash(batches):
    def batch(rows):
        ids, sums = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums, pa.string())],
                                          names=["conv_id", "repaired_sha256"])

    conv, state, begun, out = None, None, False, []
    for b in batches:
        for c, lines in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
            if state is None or c != conv:
                if state is not None:
                    out.append((conv, state.hexdigest()))
                conv, state, begun = c, hashlib.sha256(), False
            if lines is not None:
                state.update((b"\n" if begun else b"") + lines)
                begun = True
        if len(out) >= 1000:
            yield batch(out)
            out = []
    if state is not None:
        out.append((conv, state.hexdigest()))
    if out:
        yield batch(out)


def repaired_hashes(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the newline-joined ``role:text`` lines of every conversation."""
    lines = F.transform(F.arrays_zip("roles", "texts"), lambda x: F.concat(x["roles"], F.lit(":"), x["texts"]))
    joined = F.when(F.size("roles") > 0, F.array_join(lines, "\n")).cast("binary")
    return (pieces.select("conv_id", "part", "seg", joined.alias("lines")).repartition("conv_id")
            .sortWithinPartitions("conv_id", "part", "seg").mapInArrow(_hash, "conv_id bigint, repaired_sha256 string"))


def repair_report(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the hash of the repaired rows of every conversation."""
    return report_of(conversations, segments(damaged))


def report_of(conversations: DataFrame, segs: DataFrame) -> DataFrame:
    """The report of every id of ``conversations`` from the segments of their rows."""
    decided = decisions(segs)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    reports = decided.where("part IS NULL").select(F.col("conv_id").alias("_c"), *numbers, "audit")
    hashes = repaired_hashes(repaired_pieces(segs, decided)).withColumnRenamed("conv_id", "_h")
    ids = conversations.select("conv_id").distinct()
    return (ids.join(reports, ids["conv_id"].eqNullSafe(reports["_c"]), "left")
            .join(hashes, ids["conv_id"].eqNullSafe(hashes["_h"]), "left")
            .select("conv_id", *[F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in numbers],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))

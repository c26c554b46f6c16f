import hashlib
import random
import re
import zlib
from collections import defaultdict

from shoplens.llm import repair
from shoplens.llm.common import read_table

ROWS = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        roll = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if roll == 1:
            text = ""
        if roll == 2:
            text = re.sub(r"[.!?]", "", text)
        if roll == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if roll == 0 else 2 if roll == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for turn, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows, faults):
    """Every way below the price of deleting everything, by brute force: (cost, audit, repaired)."""
    limit, found = 2 * len(rows), []

    def go(i, cost, audit, kept):
        if cost > limit:
            return
        if i == len(rows) and GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in kept)):
            found.append((cost, audit, kept))
        for role in ("user", "assistant"):
            go(i, cost + 5, audit + "I", kept + [(role, "")])
        if i == len(rows):
            return
        _, role, text = rows[i]
        go(i + 1, cost + 2, audit + "D", kept)
        if faults[i] not in ("blank", "duplicate"):
            more = 5 if faults[i] == "truncated" else 0
            go(i + 1, cost + more, audit + "K", kept + [(role, text)])
            for new in ("user", "assistant"):
                go(i + 1, cost + more + 1, audit + "R", kept + [(new, text)])

    go(0, 0, "", [])
    return min(found, key=lambda f: f[:2])


def whole_strings(rows, faults):
    """The same for longer conversations: a table of the best (cost, string) from each row and state to the end."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = {s: (0, "") for s in (0, 3)} | {1: (10, "II"), 2: (5, "I")}
    for i in range(len(rows) - 1, -1, -1):
        initial, own = rows[i][1][:1], {}
        for s in after:
            ways = [(best[s][0] + 2, "D" + best[s][1])]
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                ways += [(best[t][0] + more, "K" + best[t][1]) for n, t in after[s].items() if n == initial]
                ways += [(best[t][0] + more + 1, "R" + best[t][1]) for n, t in after[s].items() if n != "s"]
            own[s] = min(ways)
        for _ in range(2):
            own = {s: min([own[s]] + [(own[t][0] + 5, "I" + own[t][1]) for n, t in after[s].items() if n != "s"]) for s in after}
        best = own
    return best[0]


def expected(rows, exhaustive):
    by = defaultdict(list)
    for conv, *_ in rows:
        by[conv]
    for conv, turn, role, text in plain_damage(rows):
        by[conv].append((turn, role, text))
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults = faults_of(own)
        turns = [t for t, _, _ in own if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        row = [max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
               sum(p not in ("su", "ua", "au") for p in pairs)]
        if exhaustive:
            cost, audit, kept = all_edits(own, faults)
            row += [cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()]
        else:
            row += list(whole_strings(own, faults))
        out[conv] = row
    return out


def report(df):
    return {r[0]: list(r[1:]) for r in repair.audits(repair.damaged(df)).collect()}


def random_rows(rng, convs, most):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "System"]
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "Same. ", "é.\x85", "End.\x1c"]
    rows = []
    for conv in convs:
        for turn in range(rng.randrange(1, most)):
            rows.append((conv, rng.choice([turn, turn, turn, None, 3 * turn]), rng.choice(roles), rng.choice(texts)))
    return rows


def test_against_all_edits(spark):
    rng = random.Random(5)
    rows = random_rows(rng, [None, *range(250)], 6)
    assert report(spark.createDataFrame(rows, ROWS)) == expected(rows, True)


def test_long_conversations(spark, monkeypatch):
    rng = random.Random(6)
    rows = random_rows(rng, range(12), 400) + [(77, t, "user", f"{t}.") for t in range(3000)]
    got, want = report(spark.createDataFrame(rows, ROWS)), expected(rows, False)
    assert {c: r[:7] for c, r in got.items()} == want


def test_back_pointers_spill(monkeypatch):
    monkeypatch.setattr(repair, "HELD", 64)
    rng = random.Random(7)
    for _ in range(30):
        rows = [(t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", "c!"])) for t in range(rng.randrange(0, 150))]
        names = ["", "blank", "duplicate", "truncated"]
        faults = faults_of(rows)
        one = repair._Conversation(1)
        for row, fault in zip(rows, faults):
            one.add(*row, names.index(fault))
        assert list(one.close()[6:8]) == list(whole_strings(rows, faults))


def test_giant_conversation_keeps_few_numbers():
    one = repair._Conversation(1)
    rng = random.Random(8)
    for turn in range(50_000):
        one.add(turn, rng.choice(["user", "assistant", "system"]), "x.", rng.randrange(4))
    assert len(one.pointers.held) == 200_000 and max(c or 0 for c in one.costs) < 13
    assert len(repair._STEPS) < 5000


def test_table_and_repaired_rows(spark, small, make_docs):
    table = read_table(spark, small, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = report(table)
    assert {c: r[:7] for c, r in got.items()} == expected(rows, False)
    left = defaultdict(list)
    for r in repair.repaired(repair.damaged(table)).collect():
        left[r.conv_id].append((r.position, r.role, r.text))
    for conv, row in got.items():
        kept = sorted(left[conv])
        assert [p for p, _, _ in kept] == list(range(1, len(kept) + 1))
        assert GRAMMAR.fullmatch("".join(role[0] for _, role, _ in kept))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in kept).encode()).hexdigest() == row[-1]


def test_empty_and_clashing(spark, small):
    from pyspark.sql import functions as F
    assert report(spark.createDataFrame([], ROWS)) == {}
    table = read_table(spark, small, "conversations")
    extra = table.select("*", *[F.lit("x").alias(c) for c in ("gone", "n", "fault", "conv", "no_conv", "_roll", "row", "position")])
    assert report(extra.repartition(5)) == report(table)


def test_all_dropped(spark):
    gone = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = report(spark.createDataFrame([(c, 0, "user", "Hi.") for c in gone], ROWS))
    empty = hashlib.sha256(b"").hexdigest()
    assert got == {c: [0, 0, 0, 0, 0, 0, "", empty] for c in gone} and gone

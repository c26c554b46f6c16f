"""Repair of conversation structure: rows sorted by conversation and turn stream through a dynamic program over roles.

A repaired conversation has the role initials `(s?(ua)+)?`. Rows are kept (0), given the role the place asks for (1) or
deleted (2, the only way for blank and repeated rows); empty user and assistant rows may be inserted (5); a truncated row
that stays costs 5 more. The cheapest edits are found, of equally cheap ones the ASCII-least string of their initials.
"""

import hashlib
from tempfile import TemporaryFile

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.operators.ordered import numbered

WHITE, ENDS = " \t\n\x0b\x0c\r", ".!?"
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
FINE, BLANK, DUPLICATE, CUT = range(4)
HELD = 1 << 22  # bytes of back pointers (4 a row) that stay in memory; older ones go to a file of the running task

# The grammar's states: nothing yet, after the system row, after a user row, after an assistant row
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLE = {"u": "user", "a": "assistant"}
ENDED = (0, 3)
# BEHIND[s][t]: what it costs at most to go on from t as one could from s. A state that is dearer than another by more
# than this is never on a cheapest way, so differences of costs stay below 13 and steps can be remembered.
BEHIND = ((0, 12, 7, 2), (0, 0, 5, 0), (5, 5, 0, 5), (0, 10, 5, 0))


def _inserts(state):
    """The states that inserted rows lead to, with the initials of the rows; going round never pays."""
    reached, initials = {state: ""}, ""
    while True:
        initial, state = next((i, n) for i, n in NEXT[state].items() if i in ROLE)
        if state in reached:
            return reached
        initials += initial
        reached[state] = initials


WAYS = [sorted(_inserts(s).items()) for s in range(4)]
_STEPS = {}


def step(costs, ranks, initial, fault):
    """One row: (costs after it, ranks after it, cost added to all, back pointers).

    `costs` by state (None: not reachable), the least of them 0; `ranks` order the states' edit strings. No such string is
    the beginning of another, for each ends with the letter of the same row, so their order never changes later. A back
    pointer is (state before, inserted initials, letter, state between), None where a state is not reached.
    """
    key = (costs, ranks, initial, fault)
    if key in _STEPS:
        return _STEPS[key]
    stays = TRUNCATED if fault == CUT else 0
    best = [None] * 4
    for before in range(4):
        if costs[before] is None:
            continue
        for between, inserted in WAYS[before]:
            paid = costs[before] + INSERT * len(inserted)
            edits = [(DELETE, "D", between)]
            if fault in (FINE, CUT):
                if initial in NEXT[between]:
                    edits.append((stays, "K", NEXT[between][initial]))
                edits += [(stays + REROLE, "R", after) for i, after in NEXT[between].items() if i in ROLE]
            for cost, letter, after in edits:
                way = (paid + cost, ranks[before], "I" * len(inserted) + letter, before, inserted, between)
                if best[after] is None or way < best[after]:
                    best[after] = way
    for state in range(4):
        if best[state] and any(other and best[state][0] > other[0] + BEHIND[state][t] for t, other in enumerate(best)):
            best[state] = None
    added = min(way[0] for way in best if way)
    order = sorted((way[1], way[2], state) for state, way in enumerate(best) if way)
    places = {state: place for place, (_, _, state) in enumerate(order)}
    result = (tuple(way and way[0] - added for way in best), tuple(places.get(s, 0) for s in range(4)), added,
              tuple(way and (way[3], way[4], way[2][-1], way[5]) for way in best))
    _STEPS[key] = result
    return result


class _Pointers:
    """Back pointers of a conversation, four bytes a row, read from the end; the older part may lie in a file."""

    LETTERS = "DKR"

    def __init__(self):
        self.held, self.file, self.chunks = bytearray(), None, 0

    def add(self, pointers):
        for p in pointers:
            self.held.append(255 if p is None else p[0] | len(p[1]) << 2 | self.LETTERS.index(p[2]) << 4)
        if len(self.held) >= HELD:
            if self.file is None:
                self.file = TemporaryFile()
            self.file.write(self.held)
            self.chunks += 1
            self.held = bytearray()

    def _backwards(self):
        yield self.held
        for chunk in range(self.chunks - 1, -1, -1):
            self.file.seek(chunk * HELD)
            yield self.file.read(HELD)

    def letters(self, state):
        """The edit string that ends in `state`."""
        out = bytearray()
        for chunk in self._backwards():
            for at in range(len(chunk) - 4, -1, -4):
                pointer = chunk[at + state]
                out += self.LETTERS[pointer >> 4].encode() + b"I" * (pointer >> 2 & 3)
                state = pointer & 3
        if self.file is not None:
            self.file.close()
        return out[::-1].decode()


class _Conversation:
    """What is known of a conversation after the rows so far: bounded, but for the back pointers."""

    def __init__(self, conv):
        self.conv = conv
        self.costs, self.ranks, self.cost = (0, None, None, None), (0, 0, 0, 0), 0
        self.hashes, self.filled = [hashlib.sha256(), None, None, None], [False] * 4
        self.pointers, self.faults, self.illegal, self.before = _Pointers(), [0] * 4, 0, None
        self.first = self.last = None
        self.turns = 0

    def add(self, turn, role, text, fault):
        if turn is not None and turn != self.last:
            self.first = turn if self.turns == 0 else self.first
            self.last, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.faults[fault] += 1
        known = initial if initial in ("s", "u", "a") else ""
        self.costs, self.ranks, added, pointers = step(self.costs, self.ranks, known, fault)
        self.cost += added
        self.pointers.add(pointers)
        self._follow(pointers, role, text)

    def _follow(self, pointers, role, text):
        """Each state carries the hash of the rows that its edits leave, so no text is kept."""
        uses = [p[0] for p in pointers if p]
        hashes, filled, raw = [None] * 4, [False] * 4, None
        for state, pointer in enumerate(pointers):
            if pointer is None:
                continue
            before, inserted, letter, between = pointer
            uses.remove(before)
            own = self.hashes[before].copy() if before in uses else self.hashes[before]
            some = self._write(own, self.filled[before], inserted)
            if letter != "D":
                if raw is None:
                    raw = text.encode()
                name = role if letter == "K" else ROLE["a" if between == 2 else "u"]
                own.update(("\n" if some else "").encode() + name.encode() + b":" + raw)
                some = True
            hashes[state], filled[state] = own, some
        self.hashes, self.filled = hashes, filled

    @staticmethod
    def _write(own, some, inserted):
        for initial in inserted:
            own.update((("\n" if some else "") + ROLE[initial] + ":").encode())
            some = True
        return some

    def close(self):
        ends = []
        for state, cost in enumerate(self.costs):
            if cost is not None:
                inserted = min((way for after, way in WAYS[state] if after in ENDED), key=len)
                ends.append((cost + INSERT * len(inserted), self.ranks[state], state, inserted))
        cost, _, state, inserted = min(ends)
        self._write(self.hashes[state], self.filled[state], inserted)
        gaps = min(self.last - self.first + 1 - self.turns, (1 << 63) - 1) if self.turns else 0
        return (self.conv, gaps, *self.faults[1:], self.illegal, self.cost + cost,
                self.pointers.letters(state) + "I" * len(inserted), self.hashes[state].hexdigest())


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _stream(frames):
    """Sorted rows in, one row per conversation out; a conversation may go on over any number of batches."""
    now = None
    for frame in frames:
        done = []
        for conv, no_conv, turn, no_turn, role, text, fault, gone in zip(*(frame[c].tolist() for c in (
                "conv", "no_conv", "turn", "no_turn", "role", "text", "fault", "gone"))):
            name = None if no_conv else conv
            if now is None or now.conv != name:
                if now is not None:
                    done.append(now.close())
                now = _Conversation(name)
            if not gone:
                now.add(None if no_turn else turn, role, text, fault)
        yield _frame(done)
    if now is not None:
        yield _frame([now.close()])


def _frame(done):
    frame = pd.DataFrame(done, columns=COLUMNS)
    return frame.astype({c: "Int64" for c in COLUMNS[:7]})


def filled(conversations):
    """(conv_id, turn, role, text, gone): null roles and texts are one space, null ids and turns stay null."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("gone"))


def damaged(conversations):
    """As `filled`, with damage by crc32(`conv_id:turn`) % 20, nulls one space: 0 drops the row (it stays as `gone`, so that
    its conversation is known), 1 empties the text, 2 takes out `.!?`, 3 repeats the row, 4 makes it a user's."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rolled = filled(conversations).withColumn("_roll", F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20)
    roll = F.col("_roll")
    copies = F.explode(F.when(roll == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")
    return rolled.select("conv_id", "turn", F.when(roll == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                         F.when(roll == 1, F.lit("")).when(roll == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
                         (roll == 0).alias("gone"), copies).drop("_copy")


def judged(rows):
    """Adds `n` (the row's number among equal roles and texts of its conversation) and `fault`, a row's first.

    Rows of a conversation go by turn, nulls first, then by role and text, so that repeated rows stand together.
    """
    rows = rows.select("conv_id", "turn", F.when(F.col("gone"), F.lit("")).otherwise(F.col("role")).alias("role"),
                       F.when(F.col("gone"), F.lit("")).otherwise(F.col("text")).alias("text"), "gone")
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    return rows.withColumn("n", F.row_number().over(seen)).withColumn(
        "fault", F.when(last == "", F.lit(BLANK)).when(F.col("n") > 1, F.lit(DUPLICATE))
        .when(~last.isin(*ENDS), F.lit(CUT)).otherwise(F.lit(FINE)))


def audits(rows):
    """One row per conversation of `rows` (as from `filled` or `damaged`): its faults, the cheapest edits and their result.

    Rows are repartitioned by conversation and sorted by turn, so a task reads one conversation after the other in
    Arrow batches and holds a few numbers and hashes of the present one, however long it is; its back pointers, four
    bytes a row, go to a file of the task beyond 4 MB. All rows with a null id are one conversation. A conversation of
    gone rows only: zeros, no edits, the hash of the empty string. `gaps` beyond a long are the largest long. An empty
    table gives an empty table; repeated rows count as duplicates; other columns are ignored.
    """
    flat = judged(rows).select(
        F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("no_conv"), F.coalesce("turn", F.lit(0)).alias("turn"),
        F.col("turn").isNull().alias("no_turn"), "role", "text", "n", "fault", "gone")
    order = ["conv", "no_conv", F.desc("no_turn"), "turn", "role", "text", "n"]
    return flat.repartition("conv", "no_conv").sortWithinPartitions(*order).mapInPandas(
        _stream, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _edits(frames):
    """Every edit of every audit: the row it is made on (by place), the place of what it leaves, a new role."""
    for frame in frames:
        out = []
        for conv, no_conv, audit in zip(frame["conv"].tolist(), frame["no_conv"].tolist(), frame["audit"].tolist()):
            left = len(audit) - audit.count("D")
            row = place = 0
            for letter in audit:
                row += letter != "I"
                place += letter != "D"
                turn = place - left % 2  # an odd number of rows starts with the system's
                role = ("assistant", "user")[turn % 2]
                out.append((None if no_conv else conv, row if letter != "I" else None, letter, place if letter != "D" else None,
                            role if letter in "IR" else None))
        yield pd.DataFrame(out, columns=["conv_id", "row", "edit", "position", "new_role"]).astype(
            {"conv_id": "Int64", "row": "Int64", "position": "Int64"})


def repaired(rows):
    """The repaired conversations: (conv_id, position from 1, turn, role, text, edit); inserted rows have no turn."""
    audit = audits(rows).select(F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("no_conv"), "audit")
    edits = audit.mapInPandas(_edits, "conv_id long, row long, edit string, position long, new_role string").where(F.col("edit") != "D")
    placed = numbered(judged(rows).where(~F.col("gone")), ["turn", "role", "text", "n"], "conv_id", name="row").select(
        F.col("conv_id").alias("_conv"), F.col("row").alias("_row"), "turn", "role", "text")
    return edits.join(placed, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("row") == F.col("_row")), "left").select(
        "conv_id", "position", "turn", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit")

"""Conversation structure repair: the cheapest edits that turn a damaged conversation into `system? (user assistant)+`.

Every row is kept (0), given the role it needs (3) or deleted (4); rows with an
empty text may be inserted (3); a kept or re-roled truncated row costs 3 more,
blank and duplicate rows must go. The repair is a shortest path over the rows
that stay. Only the role of the last row that stayed matters, so the machine holds, per
such role, the least price so far with the price of deleting all rows up to
here taken off (a prefix sum): the rows skipped before the next one that stays
then cost the difference of two prefix sums. The pair of roles tells how many rows
are inserted between. Equal prices go to the audit that is less in ASCII: audits over
the same rows are never prefixes of one another, so their order is that of the paths
they came from, then of what was appended, and a rank per role replaces the strings.

Rows are ordered by turn (nulls first), rows of one turn by the hash of role and
text. The order is cut into ranges of about equal size, wherever conversations
begin or end: a conversation inside a range is repaired there, one that touches a
range's edge gives a matrix for that segment (price, rank and audit from every role before
it to every role at its end), and matrices are multiplied in order. So a conversation
of any length is repaired by many tasks. Only SHA-256 is sequential: the task that
writes out a conversation streams its rows and holds the audit, a byte a row.

Whether a row was seen before follows from the first place of its role and text in
the conversation, a grouped minimum that is joined back with hot keys dealt over tasks.

Defined cases: null role or text: one space; null turns come first and count for no
gap; rows with a null conversation form one; repeated rows are duplicates but for the
first; an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Prices of edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: White space of the contract.
BLANKS = " \t\n\x0b\x0c\r"
#: Roles of the last row that stayed.
NONE, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Rows to insert between the role before and the next one; pairs that are missing cannot be.
BETWEEN = {(NONE, SYSTEM): 0, (NONE, USER): 0, (NONE, ASSISTANT): 1, (SYSTEM, USER): 0, (SYSTEM, ASSISTANT): 1, (USER, ASSISTANT): 0, (USER, USER): 1, (ASSISTANT, USER): 0, (ASSISTANT, ASSISTANT): 1}
#: Rows to insert at the end.
CLOSING = (0, 2, 1, 0)
FINE, BLANK, DUPLICATE, CUT = range(4)
FAR = 1 << 60


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, turn, role, text, gone): the rows with a fault each, by crc32(`conv:turn`) % 20: 0 gone, 1 empty text, 2 without `.!?`, 3 twice, 4 role user."""
    place = F.concat(F.coalesce(F.col(conv).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    fault = F.col("_f")
    rows = conversations.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), role.alias("role"), text.alias("text"), (F.crc32(place) % 20).alias("_f"))
    changed = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), (fault == 0).alias("gone"), F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_n"))
    return rows.drop("_n")


# --------------------------------------------------------------------------- the machine


class Path:
    """Least prices over the rows given so far, from one role before them, per role of the last row that stayed."""

    def __init__(self, entry: int = NONE):
        self.price = [FAR] * 4  # less the price of deleting all rows so far
        self.price[entry] = 0
        self.rank = [0] * 4
        self.gone = 0
        self.steps: list[tuple] = []  # per row, per role: (role before, letters)

    def row(self, role: int | None, fault: int) -> None:
        """One row: its role (None: a role that cannot stay) and its fault."""
        before, rank = self.price, self.rank
        came = [(before[r], rank[r], "D", r) for r in range(4)]  # deleted: the prefix sum grows, the difference stays
        if fault in (FINE, CUT):
            own = (TRUNCATED if fault == CUT else 0) - DELETE
            ways = [(x, REROLE, "R") for x in (USER, ASSISTANT)] + ([(role, 0, "K")] if role else [])
            for to, cost, letter in ways:
                for r in range(4):
                    if before[r] < FAR // 2 and (n := BETWEEN.get((r, to))) is not None:
                        way = (before[r] + n * INSERT + cost + own, rank[r], "I" * n + letter, r)
                        if way < came[to]:
                            came[to] = way
        self.gone += DELETE
        self.price = [w[0] for w in came]
        order = {key: k for k, key in enumerate(sorted({w[1:3] for w in came}))}
        self.rank = [order[w[1:3]] for w in came]
        self.steps.append(tuple((w[3], w[2]) for w in came))

    def audit(self, end: int) -> str:
        letters = []
        for step in reversed(self.steps):
            end, letter = step[end]
            letters.append(letter)
        return "".join(reversed(letters))

    def best(self) -> tuple[int, int]:
        """(price, last role) of the cheapest whole repair."""
        price, _, _, end = min((self.price[r] + self.gone + CLOSING[r] * INSERT, self.rank[r], "I" * CLOSING[r], r) for r in range(4))
        return price, end


def _follows(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


class Counts:
    """What is counted over the rows of a segment."""

    def __init__(self):
        self.rows = self.illegal = self.turns = 0
        self.faults = [0, 0, 0, 0]
        self.first = self.last = None  # initials
        self.low = self.high = None  # turns

    def row(self, turn, initial: str, fault: int) -> None:
        if self.rows:
            self.illegal += not _follows(self.last, initial)
        else:
            self.first = initial
        self.last = initial
        self.rows += 1
        self.faults[fault] += 1
        if turn is not None and (self.high is None or turn != self.high):
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def packed(self) -> list:
        return [self.rows, self.illegal, self.turns, *self.faults[1:], self.first, self.last, self.low, self.high]

    def add(self, packed: list) -> None:
        """The counts of the next segment."""
        rows, illegal, turns, blank, duplicate, cut, first, last, low, high = packed
        if not rows:
            return
        if self.rows:
            self.illegal += not _follows(self.last, first)
        else:
            self.first = first
        self.last = last
        self.rows += rows
        self.illegal += illegal
        for k, n in ((BLANK, blank), (DUPLICATE, duplicate), (CUT, cut)):
            self.faults[k] += n
        if low is not None:
            self.turns += turns - (self.high == low)
            self.low = low if self.low is None else self.low
            self.high = high

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


# --------------------------------------------------------------------------- Spark

_COUNTS = "rows long, illegal long, turns long, blank long, duplicate long, truncated long, first string, last string, low long, high long"
_DONE = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _hash():
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def _named(rows: DataFrame) -> DataFrame:
    """The rows under inner names: _c a key without nulls, o1 and o2 the order of turns."""
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    return rows.select(F.coalesce(F.concat(F.lit("k"), F.col("conv_id").cast("string")), F.lit("")).alias("_c"), "conv_id", F.col("turn").cast("long").alias("turn"), role, text, gone.alias("gone")).withColumns(
        {"o1": F.col("turn").isNotNull(), "o2": F.coalesce("turn", F.lit(0)), "h": _hash()}
    )


def _faults(rows: DataFrame) -> DataFrame:
    """(_c, conv_id, turn, o1, o2, h, u, initial, fault, gone), without texts."""
    ink = F.rtrim("text", F.lit(BLANKS))
    kind = F.when(ink == "", BLANK).when(F.right(ink, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(CUT)
    small = C.save(rows.select("_c", "conv_id", "turn", "o1", "o2", "h", F.monotonically_increasing_id().alias("u"), F.substring("role", 1, 1).alias("initial"), kind.alias("fault"), "gone"), "conversation-rows", small=True)
    place = F.struct("o1", "o2", "u")
    key = F.concat("_c", F.lit("/"), F.hex("h")).alias("_key")
    firsts = small.where("not gone").groupBy(key).agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    joined = C.salted_join(small.withColumn("_key", key), firsts, "_key", "u", how="left")
    again = F.col("_first").isNotNull() & (place != F.col("_first")) & (F.col("fault") != BLANK)
    return joined.withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("fault"))).drop("_first", "_key")


def _segments(faults: DataFrame, kind: str) -> DataFrame:
    """(_c, conv_id, seg, edge, counts, cost and audit if not edge; prices, ranks, audits if edge): a row for each conversation of each range."""
    parts = C.shuffle_parts(faults.sparkSession)
    order = ["_c", "o1", "o2", "h", "u"]
    placed = faults.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("_c", "conv_id", "turn", "initial", "fault", "gone")
    schema = f"_c string, conv_id {kind}, seg int, edge boolean, {_COUNTS}, cost long, audit string, prices array<long>, ranks array<int>, audits array<string>"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, out, size, at_start = TaskContext.get().partitionId(), [], 0, True
        now, conv, rows = None, None, []

        def close(edge: bool):
            nonlocal out, size
            counts, paths = Counts(), [Path(e) for e in range(4)] if edge else [Path()]
            for turn, initial, fault, gone in rows:
                if not gone:
                    counts.row(turn, initial, fault)
                    for p in paths:
                        p.row(INITIALS.get(initial), fault)
            out.append([now, conv, seg, edge, *counts.packed()])
            if edge:
                out[-1] += [None, None, [x + p.gone for p in paths for x in p.price], [x for p in paths for x in p.rank], [p.audit(f) if p.price[f] < FAR // 2 else None for p in paths for f in range(4)]]
            else:
                cost, end = paths[0].best()
                out[-1] += [cost, paths[0].audit(end) + "I" * CLOSING[end], None, None, None]
            size += 1 + len(rows)

        def batch():
            nonlocal out, size
            b = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)
            out, size = [], 0
            return b

        types = None
        for b in batches:
            if types is None:
                i, s = pa.int64(), pa.string()
                types = [s, b.schema.field(1).type, pa.int32(), pa.bool_(), *[i] * 6, s, s, i, i, i, s, pa.list_(i), pa.list_(pa.int32()), pa.list_(s)]
            for c, v, *row in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c != now:
                    if now is not None:
                        close(at_start)
                        at_start = False
                    now, conv, rows = c, v, []
                    if size > 1 << 17:
                        yield batch()
                rows.append(row)
        if now is not None:
            close(True)
            yield batch()

    return C.save(C.arrow(placed, run, schema), "conversation-segments")  # one task a range: its number orders the segments


def _join_segments(edges: DataFrame, kind: str) -> DataFrame:
    """Multiplies the matrices of each conversation's segments in order: (_c, conv_id, seg, entry, exit, tail; counts and cost with the last segment)."""
    fields = [c for c in edges.columns if c != "audits"]
    placed = edges.select(*fields).repartition("_c").sortWithinPartitions("_c", "seg")
    schema = f"_c string, conv_id {kind}, seg int, entry int, exit int, tail string, {_DONE}"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv in _by_conv(batches):
            counts, price, rank, back = Counts(), [0, FAR, FAR, FAR], [0] * 4, []
            for r in conv:
                counts.add(r[4:14])
                came = [min((price[m] + r[16][4 * m + f], rank[m], r[17][4 * m + f], m) for m in range(4)) for f in range(4)]
                price = [min(w[0], FAR) for w in came]
                order = {k: n for n, k in enumerate(sorted({w[1:3] for w in came}))}
                rank = [order[w[1:3]] for w in came]
                back.append([w[3] for w in came])
            cost, _, _, end = min((price[r] + CLOSING[r] * INSERT, rank[r], "I" * CLOSING[r], r) for r in range(4))
            ends = []
            for step in reversed(back):
                ends.append((step[end], end))
                end = step[end]
            ends.reverse()
            rows = [[*r[:3], entry, leave, "", *[None] * 6] for r, (entry, leave) in zip(conv, ends, strict=True)]
            rows[-1][5:] = ["I" * CLOSING[ends[-1][1]], counts.gaps(), *counts.faults[1:], counts.illegal, cost]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema([pa.field(n, t) for n, t in zip(names, _types(schema, conv[0][1]), strict=True)]))

    def _by_conv(batches):
        held: list = []
        for b in batches:
            for r in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if held and held[0][0] != r[0]:
                    yield held
                    held = []
                held.append(list(r))
        if held:
            yield held

    key_type = edges.schema["conv_id"].dataType

    def _types(schema: str, _):
        from pyspark.sql.pandas.types import to_arrow_type

        one = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
        return [to_arrow_type(key_type) if n == "conv_id" else one[x.split()[1]] for n, x in zip(names, schema.split(", "), strict=True)]

    return C.arrow(placed, run, schema)


def plan(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation, and _c, its key without nulls."""
    return _plan(_named(rows))


def _plan(named: DataFrame) -> DataFrame:
    kind = named.schema["conv_id"].dataType.simpleString()
    segments = _segments(_faults(named), kind)
    sums = [F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns")).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost"]
    inside = segments.where("not edge").select("_c", "conv_id", *sums, "audit")
    edges = segments.where("edge")
    chosen = _join_segments(edges, kind)  # at most two rows a range
    pieces = edges.select("_c", "seg", "audits").join(F.broadcast(chosen), ["_c", "seg"])
    piece = F.concat(F.get("audits", F.col("entry") * 4 + F.col("exit")), "tail")
    done = [x.split()[0] for x in _DONE.split(", ")]
    whole = pieces.groupBy("_c").agg(F.max("conv_id").alias("conv_id"), *(F.max(c).alias(c) for c in done), F.array_sort(F.collect_list(F.struct("seg", piece.alias("piece")))).alias("_p"))
    return inside.unionByName(whole.withColumn("audit", F.array_join("_p.piece", "")).drop("_p"))


def _spelled(named: DataFrame, plans: DataFrame, out: str, turns: bool) -> DataFrame:
    """Streams each conversation's rows behind its audit."""
    texts = named.where("not gone").select("_c", F.lit(1).alias("kind"), "o1", "o2", "h", "role", "text")
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("o1", "boolean"), ("o2", "long"), ("h", "binary"), ("role", "string"))]
    heads = plans.select("_c", F.lit(0).alias("kind"), *blank, F.col("audit").alias("text"))
    order = ["_c", "kind", "o1", "o2", "h"]
    placed = heads.unionAll(texts).repartition(C.shuffle_parts(named.sparkSession), "_c").sortWithinPartitions(*order).select("_c", "kind", "role", "text")
    names = [x.split()[0] for x in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, at, last, sha, n = None, "", 0, NONE, None, 0
        rows: list[tuple] = []

        def put(role, text):
            nonlocal n
            if turns:
                rows.append((now, n, role, text))
            else:
                sha.update((b"\n" if n else b"") + f"{role}:{text}".encode())
            n += 1

        def add(role=None, text=None):
            """Edits up to the one that takes the row; without a row, those at the end."""
            nonlocal at, last
            while at < len(audit):
                e, due = audit[at], USER if last != USER else ASSISTANT
                if e != "I" and role is None:
                    raise ValueError("an audit asks for more rows than there are")
                at += 1
                if e == "I":
                    put(("user", "assistant")[due - USER], "")
                    last = due
                    continue
                if e == "K":
                    put(role, text)
                    last = INITIALS[role[0]]
                elif e == "R":
                    put(("user", "assistant")[due - USER], text)
                    last = due
                return

        def close():
            add()
            if not turns:
                rows.append((now, sha.hexdigest()))

        def batch():
            b = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64() if names[k] == "position" else pa.string()) for k in range(len(names))], names)
            rows.clear()
            return b

        for b in batches:
            for c, kind, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if kind == 0:
                    if now is not None:
                        close()
                    now, audit, at, last, sha, n = c, text, 0, NONE, hashlib.sha256(), 0
                else:
                    add(role, text)
            if rows:
                yield batch()
        if now is not None:
            close()
            if rows:
                yield batch()

    return C.arrow(placed, run, out)


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    named = _named(rows)
    plans = C.save(_plan(named), "conversation-plans", small=True)
    hashes = _spelled(named, plans, "_c string, repaired_sha256 string", turns=False)
    return plans.join(hashes, "_c").drop("_c")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the rows of every repaired conversation."""
    named = _named(rows)
    plans = C.save(_plan(named), "conversation-plans", small=True)
    turns = _spelled(named, plans, "_c string, position long, role string, text string", turns=True)
    return turns.join(plans.select("_c", "conv_id"), "_c").select("conv_id", "position", "role", "text")

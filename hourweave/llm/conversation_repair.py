"""Repair of conversation structure with an audit: the cheapest edits, the ASCII-least of equally cheap ones.

A repaired conversation is empty, or an optional system turn and then user-assistant pairs. Each row is kept (K, 0),
given the role that is wanted (R, 3) or deleted (D, 4); empty turns can be inserted (I, 3). Blank and duplicate rows must
go, and a truncated row that stays costs 3 more. The edits' letters in order are the audit.

1. Rows are judged without their texts: a digest, blank, truncated. Equal rows of a conversation are one row with a count;
   the first turn of each (conversation, role, digest) comes from one aggregation, so a row is a duplicate if it is not
   the first copy there. Nothing needs the rows of a conversation together.
2. Light rows are dealt by ranges of (conversation, turn, role, digest), so a conversation of any length is cut into
   pieces of up to `PIECE` rows in many tasks. A piece gives, for each state of the pattern it may begin in, the cheapest
   audit to each state it may end in. The dynamic programme is persistent: a prefix of edits is a linked node that all its
   continuations share, with binary-lifting ancestors and a rolling hash. Equal costs are decided by the longest common
   prefix, found by binary search over hashes of prefixes and verified letter by letter, and the letters after it.
3. The pieces of a conversation are chained in order by the same programme, with whole pieces as edges.
4. Rows with texts are dealt by conversation once, sorted, and streamed through SHA-256 behind their audit. A digest of
   a whole conversation is sequential by definition; this holds one row, its audit and the hash state at a time.

Why one best prefix per state is enough: after the same number of rows two different prefixes hold the same number of
letters other than I and end in one, so neither begins with the other, and their order does not change with what follows.

Defined results: null roles and texts are one space, a null conversation id is a conversation of its own, rows with a null
turn come first. Rows of one turn are ordered by role, then by the SHA-256 of the text. A conversation whose rows are all
dropped has zeros, an empty audit and the hash of the empty string. An empty table gives no rows. Further columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourweave.llm.common import col, ship_package, slices
from hourweave.session import materialise

PIECE = 2048
SPACE = r"\x20\x09-\x0D"
LEGAL = frozenset(("su", "ua", "au"))

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn. Ends are 0 and 3.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_WANTED = ("u", "u", "a", "u")
_ROLE = {"u": "user", "a": "assistant"}
_MODULUS = (1 << 61) - 1
_BASE = 911_382_323


class Trail:
    """A string as its last piece and a shared prefix, with ancestors at powers of two and the hash of the whole."""

    __slots__ = ("piece", "length", "value", "up")

    def __init__(self, before: Trail | None = None, piece: str = "") -> None:
        self.piece = piece
        if before is None:
            self.length, self.value, self.up = 0, 0, ()
            return
        self.length = before.length + len(piece)
        self.value = _append(before.value, piece)
        up = [before]
        while len(up[-1].up) >= len(up):
            up.append(up[-1].up[len(up) - 1])
        self.up = up

    def holder(self, length: int) -> Trail:
        """The ancestor (or self) in whose piece the prefix of `length` > 0 ends."""
        node = self
        while node.up and node.up[0].length >= length:
            step = next(x for x in reversed(node.up) if x.length >= length)
            node = step
        return node

    def prefix_value(self, length: int) -> int:
        if length == 0:
            return 0
        node = self.holder(length)
        before = node.up[0]
        return _append(before.value, node.piece[: length - before.length])

    def letter(self, at: int) -> str:
        node = self.holder(at + 1)
        return node.piece[at - node.up[0].length]

    def pieces(self) -> list[str]:
        out, node = [], self
        while node.up:
            out.append(node.piece)
            node = node.up[0]
        return out[::-1]


def _append(value: int, piece: str) -> int:
    for byte in piece.encode():
        value = (value * _BASE + byte) % _MODULUS
    return value


def _same_prefix(a: Trail, b: Trail, length: int) -> bool:
    """Compares letters backwards until both are the same node."""
    while length and (x := a.holder(length)) is not (y := b.holder(length)):
        start = max(x.up[0].length, y.up[0].length)
        if x.piece[start - x.up[0].length : length - x.up[0].length] != y.piece[start - y.up[0].length : length - y.up[0].length]:
            return False
        length = start
    return True


def less(a: Trail, b: Trail) -> bool:
    """Whether `a` comes before `b` in ASCII order."""
    low, high = 0, min(a.length, b.length)
    while low < high:
        middle = (low + high + 1) // 2
        if a.prefix_value(middle) == b.prefix_value(middle):
            low = middle
        else:
            high = middle - 1
    if not _same_prefix(a, b, low):  # two texts with one hash
        return "".join(a.pieces()) < "".join(b.pieces())
    if low == a.length or low == b.length:
        return a.length < b.length
    return a.letter(low) < b.letter(low)


Best = dict[int, tuple[int, Trail]]


def _offer(best: Best, state: int, cost: int, before: Trail, piece: str) -> None:
    held = best.get(state)
    if held is None or cost < held[0]:
        best[state] = (cost, Trail(before, piece))
    elif cost == held[0] and less(new := Trail(before, piece), held[1]):
        best[state] = (cost, new)


def _inserted(best: Best) -> Best:
    """`best` with up to two inserted turns behind it; more never pay."""
    found = dict(best)
    edge = best
    for _ in range(2):
        reached: Best = {}
        for state, (cost, trail) in edge.items():
            _offer(reached, _NEXT[state, _WANTED[state]], cost + 3, trail, "I")
        for state, (cost, trail) in reached.items():
            held = found.get(state)
            if held is None or cost < held[0] or cost == held[0] and less(trail, held[1]):
                found[state] = (cost, trail)
        edge = reached
    return found


def row_edits(best: Best, kind: str) -> Best:
    """One row on: `-` must go, `s u a x` are role initials (x any other), capitals of truncated rows."""
    reached: Best = {}
    for state, (cost, trail) in _inserted(best).items():
        _offer(reached, state, cost + 4, trail, "D")
        if kind != "-":
            extra = 3 if kind.isupper() else 0
            kept = _NEXT.get((state, kind.lower()))
            if kept is not None:
                _offer(reached, kept, cost + extra, trail, "K")
            else:
                _offer(reached, _NEXT[state, _WANTED[state]], cost + extra + 3, trail, "R")
    return reached


def finished(best: Best) -> tuple[int, Trail]:
    """The cheapest trail that ends in a whole pattern."""
    ends: Best = {}
    for state, (cost, trail) in _inserted(best).items():
        if state in (0, 3) and (not ends or cost < ends[0][0] or cost == ends[0][0] and less(trail, ends[0][1])):
            ends[0] = (cost, trail)
    return ends[0]


def piece_audits(kinds: str, start: int) -> list[tuple[int, int, str]]:
    """Cheapest (end state, cost, audit) of the rows from one state."""
    best: Best = {start: (0, Trail())}
    for kind in kinds:
        best = row_edits(best, kind)
    return [(state, cost, "".join(trail.pieces())) for state, (cost, trail) in sorted(best.items())]


@lru_cache(1 << 16)
def _short_audits(kinds: str, start: int) -> list[tuple[int, int, str]]:
    return piece_audits(kinds, start)


def audits(kinds: str, start: int) -> list[tuple[int, int, str]]:
    """Short conversations have few forms, which are remembered."""
    return (_short_audits if len(kinds) <= 16 else piece_audits)(kinds, start)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) after the damage that the row's CRC chooses; a dropped row has no copies."""
    name = [F.coalesce(col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    role, text = (F.coalesce(col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        col("conv_id").alias("conv_id"), col("turn").cast("long").alias("turn"), F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _light_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows without texts: their number, faults of the text, and whether role and text came in an earlier turn."""
    word = F.col("text").rlike(rf"[^{SPACE}]")
    light = rows.groupBy("conv_id", "turn", "role", _digest(F.col("text")).alias("digest"), (~word).alias("blank"),
                         (word & ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut")).agg(F.sum("copies").alias("n"))
    when = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    first = light.where(F.col("n") > 0).groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first"))
    first = first.select(*[F.col(c).alias(f"_{c}") for c in first.columns])
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    again = F.coalesce(when != F.col("_first"), F.lit(False)).alias("again")
    return light.join(first, same, "left").select("conv_id", "turn", "role", "digest", "blank", "cut", "n", again)


_PIECE_FIELDS = "place long, n long, blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, turns long"
_EDGES = "array<struct<start:int,end:int,cost:long,audit:string>>"


def conversation_pieces(light: DataFrame, piece_rows: int = PIECE) -> DataFrame:
    """One row per piece of a conversation, in the order of `place`."""
    kind = light.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "digest"]
    parts = int(light.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # partitions come in the order of their rows
        place = TaskContext.get().partitionId() << 40
        conv, open_start, out = (), True, []
        kinds: list[str] = []
        n = blank = duplicate = truncated = illegal = turns = 0
        head = tail = low = high = None

        def close() -> None:
            nonlocal place, kinds, n, blank, duplicate, truncated, illegal, turns, head, tail, low, high, open_start
            text = "".join(kinds)
            edges = [{"start": s, "end": e, "cost": c, "audit": a} for s in ((0, 1, 2, 3) if open_start else (0,)) for e, c, a in audits(text, s)]
            out.append((conv[0], place, n, blank, duplicate, truncated, illegal, head, tail, low, high, turns, edges))
            place += 1
            kinds, n, blank, duplicate, truncated, illegal, turns = [], 0, 0, 0, 0, 0, 0
            head = tail = low = high = None
            open_start = True  # until another conversation begins

        def passed() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

        schema = pa.schema([("conv_id", id_type), *[(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _PIECE_FIELDS.split(", ")],
                            ("edges", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
        for part in slices(batches, 2048):
            for here, turn, role, no_words, cut, again, copies in zip(*(part.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 7, 6))):
                if conv != (here,):
                    if conv:
                        close()
                        open_start = False
                    conv = (here,)
                if not copies:
                    continue
                initial = role[:1]
                if turn is not None and turn != high:
                    low, high, turns = turn if low is None else low, turn, turns + 1
                for copy in range(copies):
                    if len(kinds) == piece_rows:
                        close()
                        if turn is not None:
                            low, high, turns = turn, turn, 1
                    if tail is not None and tail + initial not in LEGAL:
                        illegal += 1
                    head = initial if head is None else head
                    tail = initial
                    n += 1
                    if no_words:
                        blank += 1
                        kinds.append("-")
                    elif again or copy:
                        duplicate += 1
                        kinds.append("-")
                    else:
                        letter = initial if initial in ("s", "u", "a") else "x"
                        truncated += cut
                        kinds.append(letter.upper() if cut else letter)
            if len(out) > 1024:
                yield passed()
        if conv:
            close()
        if out:
            yield passed()

    id_type = _arrow_type(light, "conv_id")
    dealt = light.select("conv_id", "turn", "role", "digest", "blank", "cut", "n", "again").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, f"conv_id {kind}, {_PIECE_FIELDS}, edges {_EDGES}")


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


_TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def conversation_audits(pieces: DataFrame) -> DataFrame:
    """Rows (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): the pieces of each conversation chained."""
    kind, id_type = pieces.schema["conv_id"].dataType.simpleString(), _arrow_type(pieces, "conv_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, out = (), []
        best: Best = {}
        sums: dict[str, int] = {}
        low = high = tail = None
        turns = 0

        def close() -> None:
            cost, trail = finished(best)
            gaps = 0 if low is None else high - low + 1 - turns
            out.append((conv[0], gaps, sums["blank"], sums["duplicate"], sums["truncated"], sums["illegal"], cost, "".join(trail.pieces())))

        def passed() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            types = [id_type, *[pa.int64()] * len(_TOTALS), pa.string()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", *_TOTALS, "audit"])

        for batch in slices(batches, 64):
            for row in batch.to_pylist():
                if conv != (row["conv_id"],):
                    if conv:
                        close()
                    conv = (row["conv_id"],)
                    best, sums = {0: (0, Trail())}, dict.fromkeys(_TOTALS, 0)
                    low = high = tail = None
                    turns = 0
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    sums[name] += row[name]
                if row["n"]:
                    if tail is not None and tail + row["head"] not in LEGAL:
                        sums["illegal"] += 1
                    tail = row["tail"]
                if row["low"] is not None:
                    turns += row["turns"] - (high == row["low"])
                    low, high = row["low"] if low is None else low, row["high"]
                reached: Best = {}
                for edge in row["edges"]:
                    if edge["start"] in best:
                        cost, trail = best[edge["start"]]
                        _offer(reached, edge["end"], cost + edge["cost"], trail, edge["audit"])
                best = reached
                if len(out) > 4096:
                    yield passed()
        if conv:
            close()
        if out:
            yield passed()

    sums = ", ".join(f"{n} long" for n in _TOTALS)
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(run, f"conv_id {kind}, {sums}, audit string")


def repair_conversations(rows: DataFrame, piece_rows: int = PIECE) -> DataFrame:
    """Audit and repair of rows (conv_id, turn, role, text, copies), as `damaged` gives them.

    Per conversation: `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`, `audit`, `repaired_sha256`.
    """
    ship_package(rows.sparkSession)
    light = materialise(_light_rows(rows), "light-rows")
    found = materialise(conversation_audits(conversation_pieces(light, piece_rows)), "audits")
    kind, id_type = rows.schema["conv_id"].dataType.simpleString(), _arrow_type(rows, "conv_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, audit, at, state, begun, out = None, "", 0, 0, False, []
        digest = hashlib.sha256()

        def turn(role: str, text: str) -> None:
            nonlocal begun, state
            digest.update(f"\n{role}:{text}".encode() if begun else f"{role}:{text}".encode())
            begun, state = True, _NEXT[state, role[0]]

        def insert() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                at += 1
                turn(_ROLE[_WANTED[state]], "")

        def close() -> None:
            insert()
            out.append((*head, digest.hexdigest()))

        def passed() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            types = [id_type, *[pa.int64()] * len(_TOTALS), pa.string(), pa.string()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", *_TOTALS, "audit", "repaired_sha256"])

        for batch in slices(batches, 256):
            for row in batch.to_pylist():
                if row["audit"] is not None:
                    if head:
                        close()
                    head = (row["conv_id"], *(row[n] for n in _TOTALS), row["audit"])
                    audit, at, state, begun, digest = row["audit"], 0, 0, False, hashlib.sha256()
                    continue
                for _ in range(row["copies"]):
                    insert()
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        turn(row["role"] if edit == "K" else _ROLE[_WANTED[state]], row["text"])
            if len(out) > 4096:
                yield passed()
        if head:
            close()
        if out:
            yield passed()

    # the audit of a conversation stands before its rows
    order = ["conv_id", "behind", "turn", "role", "digest"]
    body = rows.where(F.col("copies") > 0).select("conv_id", "turn", "role", "text", "copies", _digest(F.col("text")).alias("digest"), F.lit(1).alias("behind"))
    both = found.withColumn("behind", F.lit(0)).unionByName(body, allowMissingColumns=True)
    sums = ", ".join(f"{n} long" for n in _TOTALS)
    return both.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, f"conv_id {kind}, {sums}, audit string, repaired_sha256 string")

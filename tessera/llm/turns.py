"""Conversation structure repair by depth-first branch-and-bound.

A conversation is legal when its role initials read ``(s?(ua)+)?``.  Its rows are
kept, given another role or deleted, and empty rows inserted, at the least
cost; of equally cheap repairs the one whose edits' initials are least in ASCII
order is taken.

The search runs over nodes (row, state), the state being the role initial last
put out.  It keeps an explicit stack, bounds each prefix by what its remaining
rows must cost at least, keeps the best whole repair so far (cost, audit), and a
table of the best prefix met at each node: a prefix that is dearer than it, or
as dear and later in order, is dropped with all that would follow.  It
ends when the stack is empty: nothing left could be better.

A long conversation is searched in pieces, in parallel: for every state before a
piece and every state after it the best edits of the piece.  Pieces are then
strung together over the states.  A conversation that fits into a piece is searched as one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import inf

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import partitions, read_table, ship_by_value, written

ship_by_value(__name__)

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
#: Added for a truncated row that stays.
TRUNCATED = 5
#: Rows searched at once; longer conversations are searched in pieces.
PIECE = 1024
#: States: nothing put out yet, then the initial put out last.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: A row's kind: a letter for its role initial, upper case if truncated, "x" if it must go, "o" for any other initial.
GONE = "x"
#: Results that a worker gathers before it hands them on.
BATCH = 500
BLANKS = r"\x20\x09-\x0D"

#: State -> the state and role that a rerole or an insertion leads to.
_TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_INITIAL = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
_ROLE = {USER: "user", ASSISTANT: "assistant"}


def _kept(kind: str, state: int) -> int | None:
    """The state after a kept row, None where its initial may not follow."""
    initial = kind.lower()
    if initial == "s":
        return SYSTEM if state == START else None
    return _TURN[state] if initial == _INITIAL[_TURN[state]] else None


def _edits(kind: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state after it) of what may be done with a row after ``state``; a reroled row that could be kept is never cheaper."""
    yield DELETE, COST[DELETE], state
    if kind != GONE:
        extra = TRUNCATED if kind.isupper() else 0
        same = _kept(kind, state)
        if same is not None:
            yield KEEP, COST[KEEP] + extra, same
        if same is None or same == SYSTEM:
            yield REROLE, COST[REROLE] + extra, _TURN[state]


def _least(kinds: str, accepted: tuple[int, ...], closing: bool) -> list[list[float]]:
    """What a prefix at (row, state) must cost at least to its end, whatever its audit: from the last row back."""
    def inserted(own: list[float]) -> list[float]:
        # insertions lead to u and a only, and more than two in a row only back to where they were
        own = [min(c, COST[INSERT] + own[_TURN[s]]) for s, c in enumerate(own)]
        return [min(c, COST[INSERT] + own[_TURN[s]]) for s, c in enumerate(own)]

    own = [0.0 if s in accepted else inf for s in range(4)]
    bound = [inserted(own) if closing else own]
    for kind in reversed(kinds):
        after = bound[-1]
        bound.append(inserted([min(cost + after[to] for _, cost, to in _edits(kind, s)) for s in range(4)]))
    return bound[::-1]


def search(kinds: str, entry: int = START, accepted: tuple[int, ...] = ACCEPTED, closing: bool = True,
           bound: list[list[float]] | None = None) -> tuple[int, str] | None:
    """The least (cost, audit) that leads over all rows from ``entry`` to one of ``accepted``; None if nothing does.

    ``closing``: rows may also be inserted after the last one.  ``bound``: that of ``_least``, if at hand.
    """
    n = len(kinds)
    bound = bound or _least(kinds, accepted, closing)
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        row, state, cost, audit = stack.pop()
        least = cost + bound[row][state]
        if least == inf or (best and (least > best[0] or (least == best[0] and audit > best[1][:len(audit)]))):
            continue
        known = table.get((row, state))
        if known and known <= (cost, audit):
            continue
        table[row, state] = (cost, audit)
        if row == n and state in accepted and (best is None or (cost, audit) < best):
            best = (cost, audit)
        nexts = [(row + 1, to, cost + more, edit) for edit, more, to in _edits(kinds[row], state)] if row < n else []
        if row < n or closing:
            nexts.append((row, _TURN[state], cost + COST[INSERT], INSERT))
        # the most promising on top of the stack, the first in order among equals
        nexts.sort(key=lambda x: (x[2] + bound[x[0]][x[1]], x[3]), reverse=True)
        stack += [(r, s, c, audit + edit) for r, s, c, edit in nexts]
    return best


def chain(tables: Iterator[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, str]:
    """Pieces strung together: the least (cost, audit) from the start to an accepted state.

    Prefixes of one cost end in the same row, so none begins another, and the least whole is made of least parts.
    """
    prefix = {START: (0, [])}
    for table in tables:
        reached: dict[int, tuple[int, list[str]]] = {}
        for (entry, last), (cost, audit) in sorted(table.items()):
            if entry not in prefix:
                continue
            whole = (prefix[entry][0] + cost, [*prefix[entry][1], audit])
            known = reached.get(last)
            if known is None or whole[0] < known[0] or (whole[0] == known[0] and "".join(whole[1]) < "".join(known[1])):
                reached[last] = whole
        # one string a state, so that its pieces aren't held again by others
        prefix = {s: (c, ["".join(parts)]) for s, (c, parts) in reached.items()}
    ends = []
    for state, (cost, parts) in prefix.items():
        tail = search("", state)
        ends.append((cost + tail[0], "".join(parts) + tail[1]))
    return min(ends)


class Replay:
    """The repaired rows (role, text) of a conversation, from its audit and its rows in order."""

    def __init__(self, audit: str):
        self.edits = iter(audit)
        self.state = START

    def _insert(self) -> tuple[str, str]:
        self.state = _TURN[self.state]
        return _ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        while (edit := next(self.edits)) == INSERT:
            yield self._insert()
        if edit == KEEP:
            self.state = SYSTEM if role[:1] == "s" else _TURN[self.state]
            yield role, text
        elif edit == REROLE:
            self.state = _TURN[self.state]
            yield _ROLE[self.state], text

    def end(self) -> Iterator[tuple[str, str]]:
        for _ in self.edits:
            yield self._insert()


# ------------------------------------------------------------------ on Spark ---

def faulty_rows(rows: DataFrame) -> DataFrame:
    """Equal rows (conv_id, turn, role, text) as one with ``copies``, numbered by (part, row) in conversation order, with:

    ``fault`` (blank, duplicate, truncated or null) and ``kind`` of the first copy.
    Order within a turn: role, then text, nulls of the turn first.
    """
    spark = rows.sparkSession
    distinct = written(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
                       .withColumn("digest", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))), "turns")
    # the first place of a text is partially aggregated; hot ones are split when it joins back
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = written(distinct.groupBy("conv_id", "digest").agg(F.min(place).alias("earliest")), "firsts")
    a, b = distinct.alias("a"), firsts.alias("b")
    met = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.digest") == F.col("b.digest"))).select(
        "a.conv_id", "a.turn", "a.role", "a.text", "a.copies", F.col("a.turn").eqNullSafe(F.col("b.earliest.turn")).alias("first"))
    blank = ~F.col("text").rlike(f"[^{BLANKS}]")
    truncated = ~F.col("text").rlike(rf"[.!?][{BLANKS}]*\z")
    fault = F.when(blank, "blank").when(~F.col("first"), "duplicate").when(truncated, "truncated")
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    kind = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    order = ("conv_id", "turn", "role", "text")
    line = (met.withColumn("fault", fault).withColumn("initial", initial).withColumn("kind", kind)
            .repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
            .withColumn("at", F.monotonically_increasing_id()))
    return written(line.select("*", F.shiftright("at", 33).cast("int").alias("part"),
                               F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("row")).drop("at"), "line")


_PIECES = ("conv_id long, part int, piece long, blank long, duplicate long, truncated long, illegal long, first_initial string, "
           "last_initial string, low long, high long, turns long, first_turn long, last_turn long, "
           "audits array<struct<entry:int,last:int,cost:long,audit:string>>")


def _missing(value) -> bool:
    return value is None or value != value


def _known(value) -> int | None:
    return None if _missing(value) else int(value)


class _Piece:
    """Rows of one conversation gathered from the sorted stream, and their counts."""

    def __init__(self, conv_id: int | None, part: int, number: int):
        self.own = {"conv_id": conv_id, "part": part, "piece": number, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                    "first_initial": None, "last_initial": None, "low": None, "high": None, "turns": 0,
                    "first_turn": None, "last_turn": None}
        self.kinds: list[str] = []
        self.size = 0

    def put(self, turn: int | None, initial: str, fault: str | None, kind: str, copies: int) -> None:
        own = self.own
        if own["last_initial"] is None:
            own["first_initial"] = initial
        elif not legal(own["last_initial"], initial):
            own["illegal"] += 1
        own["last_initial"] = initial
        if fault:
            own[fault] += 1
        # equal rows: illegal next to each other, and the later ones repeat a text if it isn't blank
        own["illegal"] += copies - 1
        own["blank" if fault == "blank" else "duplicate"] += copies - 1
        self.kinds.append(kind + GONE * (copies - 1))
        self.size += copies
        if turn is not None:
            if own["low"] is None:
                own["low"] = own["first_turn"] = turn
            own["turns"] += own["last_turn"] != turn
            own["high"] = own["last_turn"] = turn


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _solve(piece: _Piece, whole: bool) -> dict:
    kinds = "".join(piece.kinds)
    audits = []
    if whole:
        cost, audit = search(kinds)
        audits.append({"entry": START, "last": -1, "cost": cost, "audit": audit})
    else:
        for last in range(4):
            bound = _least(kinds, (last,), False)
            for entry in range(4):
                if found := search(kinds, entry, (last,), False, bound):
                    audits.append({"entry": entry, "last": last, "cost": found[0], "audit": found[1]})
    return piece.own | {"audits": audits}


def _pieces(line: DataFrame) -> DataFrame:
    """Per conversation and part its pieces with counts and best edits."""
    thin = line.select("conv_id", "part", "row", "turn", "initial", "fault", "kind", "copies")
    dealt = thin.repartition(partitions(line.sparkSession), "part").sortWithinPartitions("part", "row")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: _Piece | None = None
        key = None
        inner = False    # whether all rows of the conversation so far lie in this piece
        out: list[dict] = []
        for frame in frames:
            for conv_id, part, _, turn, initial, fault, kind, copies in frame.astype(object).itertuples(index=False, name=None):
                conv_id, turn, fault, left = _known(conv_id), _known(turn), None if _missing(fault) else fault, int(copies)
                if key != (part, conv_id):
                    if held:
                        out.append(_solve(held, inner and key[0] == part))
                    # it may have begun before the part
                    inner = key is not None and key[0] == part
                    key, held = (part, conv_id), _Piece(conv_id, int(part), 0)
                while left:
                    if held.size >= PIECE:
                        out.append(_solve(held, False))
                        held, inner = _Piece(conv_id, int(part), held.own["piece"] + 1), False
                    now = min(left, PIECE - held.size)
                    held.put(turn, initial, fault, kind, now)
                    left -= now
                    fault, kind = "blank" if fault == "blank" else "duplicate", GONE
                if len(out) >= BATCH:
                    yield pd.DataFrame(out)
                    out = []
        if held:
            out.append(_solve(held, False))    # it may go on in the next part
        if out:
            yield pd.DataFrame(out)

    return dealt.mapInPandas(run, _PIECES)


_FOUND = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _strung(pieces: DataFrame) -> DataFrame:
    """Per conversation its counts, cost and audit, from its pieces in order; a task holds one conversation's audits."""
    dealt = pieces.repartition(partitions(pieces.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "piece")

    def conversations(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for frame in frames:
            for r in frame.astype(object).itertuples(index=False):
                yield _known(r.conv_id), r

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for conv_id, rows in groupby(conversations(frames), key=lambda x: x[0]):
            total = {"conv_id": conv_id, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            seen = {"last": None, "turn": None, "low": None, "high": None, "turns": 0, "whole": None}

            def tables(rows=rows, total=total, seen=seen):
                for _, r in rows:
                    for c in ("blank", "duplicate", "truncated", "illegal"):
                        total[c] += int(getattr(r, c))
                    if seen["last"] is not None and not legal(seen["last"], r.first_initial):
                        total["illegal"] += 1
                    seen["last"] = r.last_initial
                    if not _missing(r.low):
                        seen["turns"] += int(r.turns) - (seen["turn"] == int(r.first_turn))
                        seen["turn"] = int(r.last_turn)
                        seen["low"] = int(r.low) if seen["low"] is None else seen["low"]
                        seen["high"] = int(r.high)
                    first = r.audits[0]
                    if first["last"] == -1:
                        seen["whole"] = (int(first["cost"]), first["audit"])
                    else:
                        yield {(a["entry"], a["last"]): (int(a["cost"]), a["audit"]) for a in r.audits}

            strung = chain(tables())
            cost, audit = seen["whole"] or strung
            if seen["low"] is not None:
                total["gaps"] = seen["high"] - seen["low"] + 1 - seen["turns"]
            out.append(total | {"cost": cost, "audit": audit})
            if len(out) >= BATCH:
                yield pd.DataFrame(out)
                out = []
        if out:
            yield pd.DataFrame(out)

    return dealt.mapInPandas(run, _FOUND)


def _repaired(line: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired rows, streamed in order: a task holds one audit and a batch of rows; deleted faulty rows carry no text."""
    text = F.when(F.col("kind") != GONE, F.col("text"))
    rows = line.select("conv_id", F.col("part").cast("long").alias("part"), "row", "role", text.alias("text"), "copies",
                       F.lit(None).cast("string").alias("audit"))
    audits = found.select("conv_id", F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("row"),
                          F.lit("").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), "audit")
    dealt = (rows.unionByName(audits).repartition(partitions(line.sparkSession), "conv_id")
             .sortWithinPartitions("conv_id", "part", "row"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Replay | None = None
        key, place, out = None, 0, []

        def put(pairs: Iterator[tuple[str, str]]) -> None:
            nonlocal place
            for role, text in pairs:
                out.append((key, place, role, text))
                place += 1

        def batch() -> pd.DataFrame:
            frame = pd.DataFrame(out, columns=["conv_id", "position", "role", "text"])
            out.clear()
            return frame

        for frame in frames:
            for conv_id, part, _, role, text, copies, audit in frame.astype(object).itertuples(index=False, name=None):
                if part == -1:
                    if held:
                        put(held.end())
                    key, place, held = _known(conv_id), 0, Replay(audit)
                    continue
                put(held.row(role, "" if _missing(text) else text))
                for _ in range(int(copies) - 1):
                    put(held.row(role, ""))
                if len(out) >= BATCH:
                    yield batch()
        if held:
            put(held.end())
        if out:
            yield batch()

    return dealt.mapInPandas(run, "conv_id long, position long, role string, text string")


def repair_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(found, repaired): per conversation its faults, cost and audit; and the rows (conv_id, position, role, text) after the repair.

    ``repaired`` comes conversation by conversation in the order of ``position`` within a partition.

    Null role or text: one space, so a null text is blank.  Null turn: before
    all others, no part of ``gaps``.  Null conv_id: a conversation of its own.  Rows of one
    turn: by role, then text.  Equal rows: next to each other, the later ones
    duplicates.  A role whose first character is none of s, u, a (empty too) can't be kept.  Empty table:
    empty results.  Other input columns, whatever their names, are not read.
    """
    own = rows.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                      *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    line = faulty_rows(own)
    found = written(_strung(_pieces(line)), "repairs")
    return found, _repaired(line, found)


def repaired_sha256(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the rows of ``repair_conversations`` as they come: ``role:text`` joined by line feeds.

    A hash is one pass over its conversation by its nature; the pass holds no rows.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, out = None, []
        for frame in frames:
            for conv_id, place, role, text in frame.astype(object).itertuples(index=False, name=None):
                if place == 0:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = _known(conv_id), hashlib.sha256()
                state.update((("\n" if place else "") + role + ":" + text).encode("utf-8"))
            if len(out) >= BATCH:
                yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])
                out = []
        if state:
            out.append((key, state.hexdigest()))
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])

    return repaired.mapInPandas(run, "conv_id long, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the faults that a hash of conv_id and turn asks for; nulls as one space."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).cast("int")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                shown("role").alias("role"), shown("text").alias("text"), hit.alias("hit")).filter("hit != 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    conversations = read_table(spark, sf_dir, "conversations")
    found, repaired = repair_conversations(damaged(conversations))
    hashes = repaired_sha256(repaired)
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    # one row a conversation on all sides
    f, h = found.withColumnRenamed("conv_id", "of"), hashes.withColumnRenamed("conv_id", "of")
    joined = (every.join(f, every["conv_id"].eqNullSafe(f["of"]), "left").drop("of")
              .join(h, F.col("conv_id").eqNullSafe(h["of"]), "left").drop("of"))
    return joined.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


# ------------------------------------------------------------------ reference SQL ---
_ROUND = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"


SQL = f"""
WITH RECURSIVE t0 AS (SELECT b, b AS c FROM range(0, 256) r(b)),
""" + ",\n".join(f"t{i} AS (SELECT b, {_ROUND} AS c FROM t{i - 1})" for i in range(1, 9)) + r""",
crc AS (SELECT string_agg(printf('%08x', c), '' ORDER BY b) AS crc_table FROM t8),
hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
                 regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'),
                 lambda h: ('0x' || h)::BIGINT)),
                 lambda a, b: xor(a // 256, ('0x' || substr(crc_table, 8 * (xor(a, b) % 256) + 1, 8))::BIGINT))) % 20 AS hit
        FROM conversations, crc),
dmg AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
               CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM hit, range(0, CASE WHEN hit = 3 THEN 2 ELSE 1 END) WHERE hit <> 0),
ord AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dmg),
flt AS MATERIALIZED (SELECT *, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
               CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM ord),
stats AS MATERIALIZED (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                 count(*) FILTER (fault = 't') AS truncated,
                 count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
          FROM flt GROUP BY conv_id),
-- labels of up to two insertions: from a state of role initial p (^ none) to state q
ins AS (SELECT * FROM (VALUES ('^','^',0,'',''), ('s','s',0,'',''), ('u','u',0,'',''), ('a','a',0,'',''),
          ('^','u',5,'I',E'user:\n'), ('s','u',5,'I',E'user:\n'), ('a','u',5,'I',E'user:\n'), ('u','a',5,'I',E'assistant:\n'),
          ('^','a',10,'II',E'user:\nassistant:\n'), ('s','a',10,'II',E'user:\nassistant:\n')) v(p, q, c, e, o)),
steps AS (
  SELECT conv_id, 0 AS i, '^' AS st, 0 AS cost, '' AS audit, '' AS rep FROM stats
  UNION ALL
  (SELECT conv_id, i, st, cost, audit, rep FROM (
    SELECT s.conv_id, s.i + 1 AS i, m.st, s.cost + n.c + m.cost AS cost, s.audit || n.e || m.e AS audit, s.rep || n.o || m.o AS rep,
           row_number() OVER (PARTITION BY s.conv_id, m.st ORDER BY s.cost + n.c + m.cost, s.audit || n.e || m.e) AS best
    FROM steps s JOIN ins n ON n.p = s.st JOIN flt f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1,
    LATERAL (SELECT unnest([
      {'st': n.q, 'cost': 2, 'e': 'D', 'o': ''},
      {'st': f.ini, 'cost': CASE WHEN f.fault IN ('b', 'd') OR n.q || f.ini NOT IN ('^s', '^u', 'su', 'ua', 'au') THEN 1000000
                                 WHEN f.fault = 't' THEN 5 ELSE 0 END, 'e': 'K', 'o': f.role || ':' || f.text || chr(10)},
      {'st': CASE WHEN n.q = 'u' THEN 'a' ELSE 'u' END, 'cost': CASE f.fault WHEN 't' THEN 6 WHEN '' THEN 1 ELSE 1000000 END, 'e': 'R',
       'o': CASE WHEN n.q = 'u' THEN 'assistant:' ELSE 'user:' END || f.text || chr(10)}]) AS x) z(x),
    LATERAL (SELECT x.st AS st, x.cost AS cost, x.e AS e, x.o AS o) m
    WHERE m.cost < 1000000) WHERE best = 1)),
ends AS (SELECT s.conv_id, s.cost + n.c AS cost, s.audit || n.e AS audit, s.rep || n.o AS rep
         FROM steps s JOIN stats t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.n = s.i JOIN ins n ON n.p = s.st AND n.q IN ('^', 'a')),
won AS (SELECT conv_id, cost, audit, rep FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS best FROM ends)
        WHERE best = 1)
SELECT c.conv_id, coalesce(t.gaps, 0)::BIGINT AS gaps, coalesce(t.blank, 0)::BIGINT AS blank, coalesce(t.duplicate, 0)::BIGINT AS duplicate,
       coalesce(t.truncated, 0)::BIGINT AS truncated, coalesce(t.illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost,
       coalesce(w.audit, '') AS audit,
       sha256(CASE WHEN coalesce(w.rep, '') = '' THEN '' ELSE left(w.rep, length(w.rep) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN won w ON w.conv_id IS NOT DISTINCT FROM c.conv_id
"""

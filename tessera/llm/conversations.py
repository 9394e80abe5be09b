"""Repair of conversation structure by a rank-convergence parallel Viterbi.

A conversation is repaired to the roles ``(s?(ua)+)?`` by the cheapest edits: Keep 0, Rerole to
user or assistant 2, Delete 3 (blank and duplicate rows must go), Insert an empty user or
assistant turn 2; a truncated row that stays adds 1. Of equally cheap repairs the one whose
string of edit initials is least in ASCII is taken. Four states suffice: start, after system,
after user, after assistant; which role an edit gives follows from the state.

Rows are sorted by range over all conversations, so one conversation may span tasks. Tasks
close a chunk at ``CHUNK_ROWS`` rows, ``CHUNK_BYTES`` of text or their end. A chunk that holds
its whole conversation is solved at once. The others get a speculative vector of costs to the
end (all zero; the last has the true one) and their vector at the start is computed backward.
Fix-up passes hand each chunk the vector of its successor and run again those whose vector
changed by more than a constant, until none does: min-plus maps lose rank quickly, so nearly
every chunk converges in the first pass. Costs of a row depend on its symbol and the vector's
differences alone, so a step is one look-up. Then each chunk maps its four possible states
of entry to states of exit, a pass in order of the chunks finds the true ones, and the stitched
costs drive the trace: at each row the least edit that keeps the cost.

Forced deletions change no state and come first among equal repairs, so they are not steps.
Equal rows are counted before the sort, and of equal role and text only the first row
carries its text; that first is a grouped minimum, so a text that a third of all rows repeat is
no single task. What remains in sequence is what the result asks for: one hash and one audit
string per conversation, built as a stream of its chunks' pieces in one task with constant
memory but for the audit itself (a character per edit).

Defined results: null ids are one conversation; a null turn sorts first, a null role or text is
one space, and so is each null in the key of the damage. Rows of equal turn are taken by role,
then by a hash of the text. Other roles than system, user and assistant are told by their
first character, too. No rows: zeros, empty audit, the hash of the empty string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import python_tasks, stored, table

CHUNK_ROWS, CHUNK_BYTES = 1 << 14, 2 << 20
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NO_SPACE = r"[^\x20\x09-\x0D]"

#: States: start, after system, after user, after assistant. The state that a kept initial leads to, the role a state asks for.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ASKED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: Costs to the end without rows left, and the roles then inserted.
END = (0, 4, 2, 0)
TAIL = ((), ("user", "assistant"), ("assistant",), ())


def _least(vector: tuple[int, ...]) -> tuple[int, ...]:
    low = min(vector)
    return tuple(v - low for v in vector)


@lru_cache(maxsize=None)
def step(symbol: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int, int], ...]]:
    """A row whose kept initial is ``symbol[0]`` (``-``: none) and that is truncated if ``symbol[1]`` is ``t``, before the
    costs ``after``: the costs before it, less their least, and by state the (edits, next state, cost) to take.
    The vectors' differences are bounded by the cost of inserts, so there are few."""
    initial, more = symbol[0], TRUNCATED * (symbol[1] == "t")

    def edits(s: int) -> dict[str, tuple[int, int]]:
        found = {"D": (DELETE, s), "R": (REROLE + more, AFTER[s, ASKED[s][0]])}
        if (s, initial) in AFTER:
            found["K"] = (more, AFTER[s, initial])
        return found

    costs = [min(c + after[t] for c, t in edits(s).values()) for s in range(4)]
    for _ in range(4):  # inserts before the row
        costs = [min(costs[s], INSERT + costs[AFTER[s, ASKED[s][0]]]) for s in range(4)]
    moves = []
    for state in range(4):
        taken, s, spent = "", state, 0
        while True:
            ways = {k: (c, t) for k, (c, t) in edits(s).items() if c + after[t] == costs[s]}
            t = AFTER[s, ASKED[s][0]]
            if INSERT + costs[t] == costs[s]:
                ways["I"] = (INSERT, t)
            k = min(ways)
            taken, spent, s = taken + k, spent + ways[k][0], ways[k][1]
            if k != "I":
                break
        moves.append((taken, s, spent))
    return _least(tuple(costs)), tuple(moves)


def backward(symbols: list[str], end: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before the first of ``symbols``, less their least."""
    vector = _least(end)
    for symbol in reversed(symbols):
        vector = step(symbol, vector)[0]
    return vector


def _moves(symbols: list[str], end: tuple[int, ...]) -> list[tuple[tuple[str, int, int], ...]]:
    vector, found = _least(end), []
    for symbol in reversed(symbols):
        vector, moves = step(symbol, vector)
        found.append(moves)
    return found[::-1]


def _split(packed: str) -> list[str]:
    return [packed[k:k + 2] for k in range(0, len(packed), 2)]


def _exits(symbols: list[str], end: tuple[int, ...]) -> list[int]:
    """The state after the chunk by the state before it."""
    states = list(range(4))
    for moves in _moves(symbols, end):
        states = [moves[s][1] for s in states]
    return states


def _trace(chunk: dict, end: tuple[int, ...], state: int) -> tuple[str, str, int, int]:
    """(audit, repaired rows joined by line ends, cost, state after) of a chunk entered in ``state``.

    ``forced`` counts the deletions before each row, and after the last."""
    audit, lines, cost = [], [], 0
    forced, roles, texts = chunk["forced"], chunk["roles"], chunk["texts"]
    for k, moves in enumerate(_moves(_split(chunk["symbols"]), end)):
        taken, after, spent = moves[state]
        audit.append("D" * forced[k] + taken)
        cost += DELETE * forced[k] + spent
        for _ in range(len(taken) - 1):
            lines.append(ASKED[state] + ":")
            state = AFTER[state, ASKED[state][0]]
        if taken[-1] != "D":
            lines.append((roles[k] if taken[-1] == "K" else ASKED[state]) + ":" + texts[k])
        state = after
    audit.append("D" * forced[-1])
    return "".join(audit), "\n".join(lines), cost + DELETE * forced[-1], state


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(_conv, _turn, _role, _text, _copies): rows after the damage; what it drops stays with 0 copies."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named(conv), F.lit(":"), named(turn)).cast("binary")) % 20
    return rows.select(
        F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.when(kind == 4, F.lit("user")).otherwise(named(role)).alias("_role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(named(text), "[.!?]", "")).otherwise(named(text)).alias("_text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("_copies"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Counted rows in order: by (conversation, turn, role, text) the row with the text where it is the first of its role
    and text, then the row that counts its copies and says whether it is blank."""
    rows = rows.withColumn("_key", F.sha2("_text", 256)).withColumn("_blank", ~F.col("_text").rlike(NO_SPACE))
    # nulls first, also in the minimum
    place = F.struct(F.col("_turn").isNotNull().alias("set"), F.col("_turn").alias("turn"))
    first = (rows.filter("_copies > 0 AND NOT _blank").groupBy("_conv", "_role", "_text").agg(F.min(place).alias("at"))
             .select("_conv", F.col("at.turn").alias("_turn"), "_role", F.sha2("_text", 256).alias("_key"), F.lit(0).cast("bigint").alias("_copies"), F.lit(False).alias("_blank"), "_text"))
    counted = (rows.groupBy("_conv", "_turn", "_role", "_key", "_blank").agg(F.sum("_copies").alias("_copies"))
               .select("_conv", "_turn", "_role", "_key", "_copies", "_blank", F.lit(None).cast("string").alias("_text")))
    both = stored(first.unionByName(counted))
    key = ["_conv", "_turn", "_role", "_key"]
    return both.repartitionByRange(*key).sortWithinPartitions(*key, F.col("_text").isNull())


class _Chunk:
    """What a task gathers of one conversation between two cuts."""

    def __init__(self, conv, seq: int, opens: bool):
        self.conv, self.seq, self.opens = conv, seq, opens
        self.symbols, self.forced, self.roles, self.texts, self.bytes = [], [0], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.head = self.last = self.low = self.high = self.turn_a = self.turn_z = None
        self.turns, self.rows = 0, 0

    def add(self, turn, role: str, copies: int, blank: bool, text: str | None) -> None:
        initial = role[:1]
        if self.head is None:
            self.head = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += (copies - 1) * (initial + initial not in ("su", "ua", "au"))
        self.last, self.rows = initial, self.rows + copies
        if turn is not None:
            if self.turn_a is None:
                self.turn_a, self.low = turn, turn
            if turn != self.turn_z:
                self.turns += 1
            self.turn_z = self.high = turn
        if text is None:
            self.forced[-1] += copies
            self.blank, self.duplicate = self.blank + copies * blank, self.duplicate + copies * (not blank)
            return
        cut = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1:] not in (".", "!", "?")
        self.symbols.append((initial if initial in ("s", "u", "a") else "-") + ("t" if cut else "."))
        self.forced.append(copies - 1)
        self.truncated, self.duplicate = self.truncated + cut, self.duplicate + copies - 1
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text) + len(role)


_FIELDS = ("conv", "part", "seq", "opens", "closes", "symbols", "forced", "roles", "texts", "blank", "duplicate", "truncated", "illegal", "head", "last",
           "turn_a", "turn_z", "turns", "rows")


def _chunk_schema(conv: str, turn: str) -> str:
    return (f"conv {conv}, part int, seq int, opens boolean, closes boolean, symbols string, forced array<bigint>, roles array<string>, texts array<string>, "
            f"blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, last string, turn_a {turn}, turn_z {turn}, turns bigint, rows bigint")


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def chunked(ordered: DataFrame, rows: int = CHUNK_ROWS, size: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk, told by (part, seq). ``opens``: the conversation may begin in another chunk; ``closes``: it may go on in another."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = dict(ordered.dtypes)
    text = _chunk_schema(kinds["_conv"], kinds["_turn"])
    arrow = to_arrow_schema(_parse_datatype_string(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, out, held = TaskContext.get().partitionId(), None, [], 0
        pending = None  # the row that carries a text, until the one with its count

        def close(goes_on: bool) -> None:
            nonlocal held
            held += now.bytes + 64
            own = {f: getattr(now, f) for f in _FIELDS if f not in ("part", "closes", "symbols")}
            out.append(own | {"part": part, "closes": goes_on, "symbols": "".join(now.symbols)})

        for batch in batches:
            for conv, turn, role, copies, blank, words in zip(*(batch.column(c).to_pylist() for c in ("_conv", "_turn", "_role", "_copies", "_blank", "_text"))):
                if now is None or conv != now.conv:
                    if now is not None:
                        close(False)
                    now = _Chunk(conv, 0 if now is None else now.seq + 1, now is None)
                elif words is not None and (len(now.symbols) >= rows or now.bytes >= size):
                    close(True)
                    now = _Chunk(conv, now.seq + 1, True)
                if words is not None:
                    pending = words
                elif copies:
                    now.add(turn, role, copies, blank, pending)
                    pending = None
            if held > size:
                yield _batch(out, arrow)
                out, held = [], 0
        if now is not None:
            close(True)
        yield _batch(out, arrow)

    return ordered.mapInArrow(run, text)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [list(backward(_split(s), tuple(e))) for s, e in zip(batch.column("symbols").to_pylist(), batch.column("end").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("end"), pa.array(found, pa.list_(pa.int32()))], names=["id", "end", "start"])


def _exit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_exits(_split(s), tuple(e)) for s, e in zip(batch.column("symbols").to_pylist(), batch.column("end").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("end"), pa.array(found, pa.list_(pa.int32()))], names=["id", "end", "exits"])


def _entry_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order: the state each is entered in."""
    state = START
    for batch in batches:
        found = []
        for k, exits in zip(batch.column("k").to_pylist(), batch.column("exits").to_pylist()):
            state = START if k == 1 else state
            found.append(state)
            state = exits[state]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("end"), pa.array(found, pa.int32())], names=["id", "end", "entry"])


def converged(open_chunks: DataFrame) -> tuple[DataFrame, int]:
    """(part, seq, end, entry) of chunks that hold only part of a conversation, and the number of passes run.

    ``end``: the true costs after the chunk, less their least. Chunks without a step are left out."""
    ids = F.struct("part", "seq").alias("id")
    every = Window.partitionBy("conv").orderBy("part", "seq")
    # small rows: one per chunk, without its steps
    linked = stored(open_chunks.filter("symbols <> ''").select("conv", ids, "part", "seq").select(
        "id", F.row_number().over(every).alias("k"), F.lead("id").over(every).alias("next"), F.xxhash64("conv").alias("group")))
    steps = open_chunks.filter("symbols <> ''").select(ids, "symbols")
    start = F.when(F.col("next").isNull(), F.array(*map(F.lit, END))).otherwise(F.array(*[F.lit(0)] * 4)).cast("array<int>").alias("end")
    state = stored(linked.select("id", start).join(steps, "id").select("id", "end", "symbols").mapInArrow(_vectors, "id struct<part:int,seq:int>, end array<int>, start array<int>"))
    passes = 0
    while True:
        passes += 1
        succ = state.select(F.col("id").alias("next"), F.col("start").alias("given"))
        handed = linked.filter("next IS NOT NULL").join(succ, "next").select("id", "given")
        less = F.transform("end", lambda v: v - F.array_min("end"))
        marked = stored(state.join(handed, "id", "left").withColumn("stale", F.col("given").isNotNull() & (F.col("given") != less)))
        if not marked.filter("stale").limit(1).count():
            break
        again = marked.filter("stale").select("id", F.col("given").alias("end")).join(steps, "id").select("id", "end", "symbols")
        state = stored(marked.filter("NOT stale").select("id", "end", "start").unionByName(again.mapInArrow(_vectors, "id struct<part:int,seq:int>, end array<int>, start array<int>")))
    exits = state.select("id", "end").join(steps, "id").select("id", "end", "symbols").mapInArrow(_exit_rows, "id struct<part:int,seq:int>, end array<int>, exits array<int>")
    in_order = linked.select("id", "k", "group").join(exits, "id").repartition("group").sortWithinPartitions("group", "k")
    entries = in_order.select("id", "k", "end", "exits").mapInArrow(_entry_rows, "id struct<part:int,seq:int>, end array<int>, entry int")
    return stored(entries.select("id.part", "id.seq", "end", "entry")), passes


_PIECE = "rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, last string, turns bigint, audit string, repaired string, kept boolean, cost bigint, exit int"


def _traced(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for chunk in batch.to_pylist():
                # a chunk without steps leaves its state as it is: none is told here
                audit, repaired, cost, state = _trace(chunk, tuple(chunk["end"] or END), chunk["entry"] or START)
                out.append({c: chunk[c] for c in schema.names if c in chunk}
                           | {"audit": audit, "repaired": repaired, "kept": repaired != "", "cost": cost, "exit": state if chunk["symbols"] else None})
            yield _batch(out, schema)
    return run


_RESULT = "rows bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _assembled(schema: pa.Schema):
    """Pieces in order to one row per conversation: counts add up, what meets at a cut is told from the cut's two sides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, size = None, [], 0

        def close() -> None:
            for role in TAIL[now["state"]]:
                add(role + ":")
                now["audit"].append("I")
                now["cost"] += INSERT
            gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
            out.append({"conv": now["conv"], "gaps": gaps, "audit": "".join(now["audit"]), "repaired_sha256": now["hash"].hexdigest()}
                       | {c: now[c] for c in ("rows", "blank", "duplicate", "truncated", "illegal", "cost")})

        def add(lines: str) -> None:
            if now["any"]:
                now["hash"].update(b"\n")
            now["hash"].update(lines.encode())
            now["any"] = True

        for batch in batches:
            for p in batch.to_pylist():
                if now is None or p["conv"] != now["conv"]:
                    if now is not None:
                        close()
                        size += sum(map(len, now["audit"])) + 200
                    now = {"conv": p["conv"], "hash": hashlib.sha256(), "any": False, "state": START, "audit": [], "last": None, "low": None, "high": None, "z": None,
                           "rows": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "turns": 0}
                if p["head"] is not None:
                    if now["last"] is not None and now["last"] + p["head"] not in ("su", "ua", "au"):
                        now["illegal"] += 1
                    now["last"] = p["last"]
                for c in ("rows", "blank", "duplicate", "truncated", "illegal", "cost", "turns"):
                    now[c] += p[c]
                if p["turn_a"] is not None:
                    now["turns"] -= now["high"] == p["turn_a"]
                    now["low"] = p["turn_a"] if now["low"] is None else now["low"]
                    now["high"] = p["turn_z"]
                now["audit"].append(p["audit"])
                if p["kept"]:
                    add(p["repaired"])
                now["state"] = now["state"] if p["exit"] is None else p["exit"]
            if size > CHUNK_BYTES:
                yield _batch(out, schema)
                out, size = [], 0
        if now is not None:
            close()
        yield _batch(out, schema)
    return run


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per conversation of ``damaged``-like rows: ``conv``, counts, ``cost``, ``audit`` and ``repaired_sha256``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    python_tasks(rows.sparkSession)
    kinds = dict(rows.dtypes)
    chunks = stored(chunked(_ordered(rows), chunk_rows, chunk_bytes))
    whole = ~F.col("opens") & ~F.col("closes")
    entries, _ = converged(chunks.filter(~whole))
    none = [F.lit(None).cast("array<int>").alias("end"), F.lit(None).cast("int").alias("entry")]
    rest = chunks.filter(~whole).join(entries, ["part", "seq"], "left").select("*")
    ready = chunks.filter(whole).select("*", *none).unionByName(rest)
    text = f"conv {kinds['_conv']}, part int, seq int, opens boolean, closes boolean, turn_a {kinds['_turn']}, turn_z {kinds['_turn']}, {_PIECE}"
    pieces = lambda df: df.mapInArrow(_traced(to_arrow_schema(_parse_datatype_string(text))), text)
    text_out = f"conv {kinds['_conv']}, {_RESULT}"
    run = _assembled(to_arrow_schema(_parse_datatype_string(text_out)))
    settled = pieces(ready.filter(whole)).mapInArrow(run, text_out)
    order = F.xxhash64("conv")
    crossing = pieces(ready.filter(~whole)).repartition(order).sortWithinPartitions(order, "conv", "part", "seq").mapInArrow(run, text_out)
    return settled.unionByName(crossing)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair(damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
    return found.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "rows")

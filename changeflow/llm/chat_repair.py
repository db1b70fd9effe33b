"""Repair of damaged conversations at least cost: a scan of min-plus matrices.

The roles of a repaired conversation, by their initials, have to read ``(s?(ua)+)?``: at most one system turn, then pairs of user and
assistant. The automaton of that pattern has four states (begun, after s, after u, after a). A turn may be kept (K), given the
role user or assistant (R), deleted (D), and turns with empty text may be inserted anywhere (I); ``COST`` has the prices. Blank turns
and repeats (role and text seen before in the conversation) have to go, turns that break off cost more if they stay.

Each turn is a 4x4 matrix: entry (i, j) is the best way from state i to j over this turn and any inserts behind it (``CLOSURE``, the
closure of single inserts), as a pair of cost and audit, the letters of the edits. Products add costs and join audits, and take the
least pair. That is a semiring: an audit fixes its cost, so two audits of equal cost over the same turns are never one the
beginning of the other, and what compares less still does after more letters. Products are therefore associative: turns are sorted by
range over conversation and turn, each task multiplies what it has of a conversation in a balanced tree (``Product``), and
the few products of a conversation that runs over several partitions are multiplied in order, likewise.

What else is told of a conversation (faults, gaps, illegal neighbours) is carried in the same elements (``Segment``). A last pass streams
each conversation's turns behind its audit through one task, with one turn and the audit in memory, because a digest is sequential.

Edge cases: nulls of any column are one space; unknown roles can't be kept; ties of turn are ordered by role, then text; equal rows
are repeats; rows with a null conv_id form one conversation; conversations without turns have zeros, an empty audit and
the digest of the empty string; the audit of a conversation, one letter an edit, has to fit into a task's memory some 30 times over, its turns
needn't; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, drop_stored, stored

#: Prices of edits; ``cut``: a truncated turn that stays.
COST = {"K": 0, "R": 3, "D": 4, "I": 3, "cut": 3}
STATES, BEGUN, ENDS = 4, 0, (0, 3)
#: Where a role leads from a state, by its initial: after s, after u, after a.
LEADS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The role that a changed or inserted turn has in a state, and the state after it.
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
LEGAL = ("su", "ua", "au")
KEPT, BLANK, REPEAT, CUT = 0, 1, 2, 3
WHITE = " \t\n\x0b\x0c\r"

Entry = tuple[int, str] | None
Matrix = tuple[Entry, ...]
UNIT: Matrix = tuple((0, "") if i == j else None for i in range(STATES) for j in range(STATES))


def plus(a: Matrix, b: Matrix) -> Matrix:
    return tuple(y if x is None else x if y is None else min(x, y) for x, y in zip(a, b, strict=True))


def times(a: Matrix, b: Matrix) -> Matrix:
    out = []
    for i in range(0, 16, 4):
        for j in range(4):
            ways = [(x[0] + y[0], x[1], y[1]) for x, y in zip(a[i : i + 4], b[j::4], strict=True) if x is not None and y is not None]
            if ways:
                cost = min(w[0] for w in ways)
                out.append((cost, min(w[1] + w[2] for w in ways if w[0] == cost)))  # only the cheapest are joined
            else:
                out.append(None)
    return tuple(out)


def _moves(steps: dict[tuple[int, int], Entry]) -> Matrix:
    return tuple(steps.get((i, j)) for i in range(STATES) for j in range(STATES))


_INSERT = _moves({(i, j): (COST["I"], "I") for i, (_, j) in NEXT.items()})


def _closure(one: Matrix) -> Matrix:
    """Any number of steps: no cheapest way over four states has more than three."""
    out = UNIT
    for _ in range(STATES - 1):
        out = plus(UNIT, times(out, one))
    return out


CLOSURE = _closure(_INSERT)


@lru_cache(maxsize=None)
def turn_matrix(initial: str, fault: int) -> Matrix:
    """The matrix of a turn, by the initial of its role and its fault: a dozen in all."""
    steps = {(i, i): (COST["D"], "D") for i in range(STATES)}
    if fault in (KEPT, CUT):
        more = COST["cut"] if fault == CUT else 0
        for letter, moves in (("R", {i: j for i, (_, j) in NEXT.items()}), ("K", LEADS.get(initial, {}))):
            for i, j in moves.items():
                steps[i, j] = (COST[letter] + more, letter)
    return times(_moves(steps), CLOSURE)


@lru_cache(maxsize=1 << 14)
def _leaf(turns: tuple[tuple[str, int], ...]) -> Matrix:
    out = turn_matrix(*turns[0])
    for t in turns[1:]:
        out = times(out, turn_matrix(*t))
    return out


class Product:
    """Ordered product of matrices as a balanced tree, of which only one branch a level is held."""

    def __init__(self) -> None:
        self.held: list[tuple[int, Matrix]] = []

    def add(self, matrix: Matrix) -> None:
        size = 1
        while self.held and self.held[-1][0] <= size:
            n, left = self.held.pop()
            matrix, size = times(left, matrix), size + n
        self.held.append((size, matrix))

    def value(self) -> Matrix:
        out = UNIT
        for _, matrix in reversed(self.held):
            out = times(matrix, out)
        return out


FACTS = ["n", "blank", "repeated", "cut", "illegal", "turns"]
SEGMENT = "conv_id long, pos long, " + ", ".join(f"{f} long" for f in FACTS) + ", first string, last string, low long, high long, costs array<long>, audits array<string>"
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Segment:
    """What is known of some adjacent turns of a conversation."""

    LEAF = 4

    def __init__(self, conv_id: int | None, pos: int):
        self.conv_id, self.pos, self.product, self.leaf = conv_id, pos, Product(), []
        self.n = self.blank = self.repeated = self.cut = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def turn(self, turn: int | None, initial: str, fault: int) -> None:
        self.blank, self.repeated, self.cut = self.blank + (fault == BLANK), self.repeated + (fault == REPEAT), self.cut + (fault == CUT)
        self._behind(1, initial, initial, turn, turn, turn is not None)
        self.leaf.append((initial, fault))
        if len(self.leaf) == self.LEAF:
            self._settle()

    def _settle(self) -> None:
        if self.leaf:
            self.product.add(_leaf(tuple(self.leaf)))
            self.leaf = []

    def _behind(self, n: int, first: str, last: str, low: int | None, high: int | None, turns: int) -> None:
        self.illegal += self.n > 0 and self.last + first not in LEGAL
        self.turns += turns - (low is not None and low == self.high)
        self.n, self.last = self.n + n, last
        self.first = first if self.first is None else self.first
        self.low = low if self.low is None else self.low
        self.high = self.high if high is None else high

    def join(self, row: dict) -> None:
        """The next segment of the conversation, as a row."""
        for f in ("blank", "repeated", "cut", "illegal"):
            setattr(self, f, getattr(self, f) + row[f])
        self._behind(row["n"], row["first"], row["last"], row["low"], row["high"], row["turns"])
        self.product.add(tuple(None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True)))

    def row(self) -> tuple:
        self._settle()
        matrix = self.product.value()
        costs, audits = [x and x[0] for x in matrix], [x and x[1] for x in matrix]
        return (self.conv_id, self.pos, *(getattr(self, f) for f in FACTS), self.first, self.last, self.low, self.high, costs, audits)

    def result(self) -> tuple:
        self._settle()
        matrix = times(CLOSURE, self.product.value())
        cost, audit = min(x for x in (matrix[BEGUN * STATES + j] for j in ENDS) if x is not None)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.repeated, self.cut, self.illegal, cost, audit)


_ARROW = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)], [name for name, _ in fields])


def _grouped(batches: Iterator[pa.RecordBatch], begin, take, end, ddl: str) -> Iterator[pa.RecordBatch]:
    """Streams rows, sorted by their first column conv_id, through one state a conversation."""
    now, done, size = None, [], 0
    for batch in batches:
        for row in batch.to_pylist():
            if now is None or now.conv_id != row["conv_id"]:
                if now is not None:
                    done.append(end(now))
                    size += sum(len(x) for x in done[-1] if isinstance(x, str))
                now = begin(row)
            take(now, row)
            if len(done) >= 1000 or size > 1 << 22:
                yield _batch(done, ddl)
                done, size = [], 0
    if now is not None:
        done.append(end(now))
    if done:
        yield _batch(done, ddl)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _grouped(batches, lambda r: Segment(r["conv_id"], r["pos"]), lambda s, r: s.turn(r["turn"], r["initial"], r["fault"]), Segment.row, SEGMENT)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _grouped(batches, lambda r: Segment(r["conv_id"], r["pos"]), Segment.join, Segment.result, RESULT)


class Edited:
    """Carries out an audit on the turns that come after it; what is repaired goes to a digest."""

    def __init__(self, row: dict):
        self.conv_id, self.facts, self.audit = row["conv_id"], row, row["audit"] or ""
        self.at, self.state, self.digest, self.n = 0, BEGUN, hashlib.sha256(), 0

    def put(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.n else ''}{role}:{text}".encode())
        self.n += 1

    def _next(self, text: str) -> None:
        role, self.state = NEXT[self.state]
        self.put(role, text)

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._next("")

    def take(self, row: dict) -> None:
        if row["pos"] < 0:
            return
        self._inserts()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self.state = LEADS[row["role"][:1]][self.state]
            self.put(row["role"], row["text"])
        elif letter == "R":
            self._next(row["text"])

    def row(self) -> tuple:
        self._inserts()
        if self.at != len(self.audit):
            raise ValueError("an audit doesn't fit its conversation")
        return (*(self.facts[f.split(" ")[0]] for f in RESULT.split(", ")), self.digest.hexdigest())


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _grouped(batches, Edited, Edited.take, Edited.row, RESULT + ", repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32(conv_id:turn) % 20 says: 0 drops a row, 1 empties its text, 2 takes its
    full stops, exclamation and question marks, 3 repeats it, 4 makes its role user. Nulls are one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("_d"))
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.filter("_d <> 0").select("conv_id", "turn", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("_copy"))
    return rows.drop("_copy")


def judged(spark: SparkSession, turns: DataFrame, kept: list[str]) -> DataFrame:
    """conv_id, pos, turn, initial and fault of turns (conv_id, pos, turn, role, text), the first fault of each."""
    tail = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    facts = turns.select(
        "conv_id", "pos", "turn", F.when(initial.isin(*LEADS), initial).otherwise("?").alias("initial"), (tail == "").alias("blank"), (~F.right(tail, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same"),
    )
    facts = stored(spark, facts, "facts", kept)
    # written first: then the join is by plain shuffles, and a text that many turns of a conversation have can be split
    first = facts.filter("not blank").groupBy("conv_id", "same").agg(F.min("pos").alias("begin"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv_id").alias("_conv"), F.col("same").alias("_same"), "begin")
    first = checkpointed(spark, first)
    known = facts.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same")) & ~F.col("blank"), "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("pos") > F.col("begin"), REPEAT).when(F.col("cut"), CUT).otherwise(KEPT)
    return known.select("conv_id", "pos", "turn", "initial", fault.alias("fault"))


def repair(spark: SparkSession, conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row for each conv_id of ``conversations``: faults, cost, audit and digest of the repaired turns.

    ``rows`` (conv_id, turn, role, text) are the turns to repair, the conversations' own without it; nulls of role and text are one space.
    """
    rows = conversations if rows is None else rows
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "_salt"]  # the salt spreads equal rows over ranges
    placed = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    kept: list[str] = []
    turns = stored(spark, placed.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "turns")
    parts = judged(spark, turns, kept).repartitionByRange("pos").sortWithinPartitions("pos").mapInArrow(_segments, SEGMENT)
    found = parts.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_results, RESULT)
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    heads = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(F.col("_id").alias("conv_id"), F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"))
    heads = stored(spark, heads, "heads")
    drop_stored(spark, kept)
    both = heads.unionByName(turns.select("conv_id", "pos", "role", "text"), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_edited, RESULT + ", repaired_sha256 string")


def _append(src: str, cost: str, letter: str, turn: str | None) -> str:
    text = f"CASE WHEN {src}.n = 0 THEN {turn} ELSE {src}.t || chr(10) || {turn} END" if turn else f"{src}.t"
    return f"{{'c': {src}.c + {cost}, 'a': {src}.a || '{letter}', 'n': {src}.n + {1 if turn else 0}, 't': {text}}}"


def _least(ways: list[str]) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]"


def repair_sql() -> str:
    """The same in DuckDB: one step of recursion a turn over the four states, each with cost, audit and repaired text."""
    turn_of = {i: f"'{role}:'" for i, (role, _) in NEXT.items()}
    steps: dict[int, list[str]] = {j: [f"CASE WHEN s{j} IS NOT NULL THEN {_append(f's{j}', str(COST['D']), 'D', None)} END"] for j in range(STATES)}
    for i, (_, j) in NEXT.items():
        steps[j].append(f"CASE WHEN s{i} IS NOT NULL AND fault IN ({KEPT}, {CUT}) THEN {_append(f's{i}', f'{COST["R"]} + more', 'R', f'{turn_of[i]} || text')} END")
    for initial, moves in LEADS.items():
        for i, j in moves.items():
            steps[j].append(f"CASE WHEN s{i} IS NOT NULL AND fault IN ({KEPT}, {CUT}) AND initial = '{initial}' THEN {_append(f's{i}', f'{COST["K"]} + more', 'K', "role || ':' || text")} END")
    one = "conv_id, k, " + ", ".join(f"{_least(steps[j])} AS s{j}" for j in range(STATES))

    def closed(inner: str) -> str:
        for _ in range(STATES - 1):
            ways = {j: [f"s{j}"] for j in range(STATES)}
            for i, (_, j) in NEXT.items():
                ways[j].append(f"CASE WHEN s{i} IS NOT NULL THEN {_append(f's{i}', str(COST['I']), 'I', turn_of[i])} END")
            inner = f"SELECT conv_id, k, {', '.join(f'{_least(ways[j])} AS s{j}' for j in range(STATES))} FROM ({inner})"
        return inner

    nil, start = "NULL::STRUCT(c BIGINT, a VARCHAR, n BIGINT, t VARCHAR)", "{'c': 0::BIGINT, 'a': '', 'n': 0::BIGINT, 't': ''}"
    begin = f"SELECT conv_id, 0::BIGINT AS k, {start} AS s0, {nil} AS s1, {nil} AS s2, {nil} AS s3 FROM ids"
    step = f"SELECT {one} FROM (SELECT p.conv_id, t.k, s0, s1, s2, s3, role, text, initial, fault, CASE WHEN fault = {CUT} THEN {COST['cut']} ELSE 0 END AS more FROM paths p JOIN faults t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.k = p.k + 1)"
    white = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]), lambda c, _k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
keyed AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h FROM conversations),
dealt AS (
  SELECT * EXCLUDE (h), xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 20 AS d FROM keyed, crc_table),
turned AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM dealt WHERE d <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k, left(role, 1) AS initial,
    NOT regexp_matches(text, '{white}') AS blank, regexp_extract(text, '({white})[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut FROM turned),
faults AS (
  SELECT *, CASE WHEN blank THEN {BLANK} WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN {REPEAT} WHEN cut THEN {CUT} ELSE {KEPT} END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS pair FROM numbered),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = {BLANK}) AS blank, count(*) FILTER (fault = {REPEAT}) AS duplicate,
    count(*) FILTER (fault = {CUT}) AS truncated, count(*) FILTER (k > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS n FROM faults GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id::BIGINT AS conv_id FROM conversations),
paths AS (
  {closed(begin)}
  UNION ALL
  {closed(step)}),
ended AS (SELECT p.conv_id, p.k, {_least(["s0", "s3"])} AS s FROM paths p)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  e.s.c::BIGINT AS cost, e.s.a AS audit, sha256(e.s.t) AS repaired_sha256
FROM ids i LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM i.conv_id JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id AND e.k = coalesce(f.n, 0)"""

"""Repair of conversation structure at least cost, by the auction algorithm for shortest paths.

A conversation should be an optional system turn and then user and assistant turns in alternation,
`(s?(ua)+)?` in initials. Its rows in order span a lattice: node (i, q) has i rows behind it and the
grammar in state q. Arcs are edits. K keeps a row (0), R makes it the user or assistant turn the
state waits for (2), D deletes it (3), I inserts an empty turn of that kind (2). Blank and duplicate
rows have to be deleted; keeping or changing a truncated row costs 1 more. A shortest path is a
cheapest repair.

The auction (Bertsekas, 1991) holds a price for every node and one path from the origin. At the
path's last node it compares the price with the best offer, arc cost plus the price behind it: a
price below the best offer is raised to it and the path gives up its last arc, otherwise the path is
extended to the node of the best offer, until it reaches the end. Costs are integers and every cycle
costs something, so it ends, and then every arc of every shortest path is tight: its cost is the
difference of the prices. Of the cheapest repairs the one with the ASCII-least string of letters is
traced along tight arcs.

Work grows with the length of the lattice times its cost, so a lattice of more than STRETCH rows is
solved in stretches: from the last one to the first, auctions from all states at its start leave
exact prices there, which the stretch before it has as prices of its end; then the path is traced
forwards, stretch by stretch. The number of steps is proportional to the rows.

Rows are dealt out by conversation and sorted, and tasks read them as a stream. Of one conversation
a task holds one byte a row, then one letter a row (the result has to hold those as well), and one
state of the digest, which by definition takes the texts one after the other. So a conversation of
any length needs no more memory than its own result row. Duplicates are found by digest beforehand,
with an aggregation and a join that spread hot digests.

Defined results: null ids, roles and texts count as one space where they are read; a null id is one
conversation, with a null id in the result. Null turns come first; rows of one turn go by role, then
by the MD5 of their text; equal rows may swap. A role is known by its first letter; an empty or
unknown one can't be kept. Long texts are only streamed. An empty table gives an empty result. Other
columns play no role.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakepipe.llm.frames import quoted, ship, table
from lakepipe.operators.joins import lookup_join
from lakepipe.session import checkpoint

#: Rows of a lattice that one auction crosses.
STRETCH = 64
DELETE, RENAME, INSERT, UNFINISHED = 3, 2, 2, 1
WHITE = " \t\n\x0b\x0c\r"

# States of the grammar: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, OPENED, ASKED, ANSWERED = range(4)
# The state that keeping a row of some initial leads to.
KEPT = {
    START: {"s": OPENED, "u": ASKED},
    OPENED: {"u": ASKED},
    ASKED: {"a": ANSWERED},
    ANSWERED: {"u": ASKED},
}
# The turn a state waits for, and where it leads.
WANTED = {START: ASKED, OPENED: ASKED, ASKED: ANSWERED, ANSWERED: ASKED}
ROLE_OF = {ASKED: "user", ANSWERED: "assistant"}
COMPLETE = (0, None, None, 0)

# A row's byte: its initial (s, u, a, or a dot for any other), and what is wrong with it.
INITIALS = "sua."
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3


def code_of(initial: str, fault: int) -> int:
    return 4 * INITIALS.index(initial if initial in INITIALS[:3] and initial else ".") + fault


def _arcs(rows: bytes, exits: tuple[int | None, ...], last: bool) -> list[list[tuple[str, int, int]]]:
    """Arcs (letter, next node, cost) of the nodes 4 * i + q, letters ascending; the end is the node after them.

    `exits` are the prices of the four states behind the last row, None where there is no way on.
    Turns are inserted in front of rows, behind the last one only at the end of a conversation.
    """
    end = 4 * (len(rows) + 1)
    arcs: list[list[tuple[str, int, int]]] = []
    for i, code in enumerate(rows):
        initial, fault = INITIALS[code >> 2], code & 3
        extra = UNFINISHED if fault == TRUNCATED else 0
        for q in range(4):
            out = [("D", 4 * (i + 1) + q, DELETE), ("I", 4 * i + WANTED[q], INSERT)]
            if fault not in (BLANK, DUPLICATE):
                if initial in KEPT[q]:
                    out.append(("K", 4 * (i + 1) + KEPT[q][initial], extra))
                out.append(("R", 4 * (i + 1) + WANTED[q], RENAME + extra))
            arcs.append(out)
    for q in range(4):
        out = [("", end, exits[q])] if exits[q] is not None else []
        arcs.append(out + [("I", end - 4 + WANTED[q], INSERT)] * last)
    return arcs


def auction(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int) -> int:
    """Raise `prices` until a shortest path from `origin` to the last node is tight; its length."""
    end, path = len(arcs), [origin]
    while path[-1] != end:
        node = path[-1]
        best, to = None, end
        for _, after, cost in arcs[node]:
            offer = cost + prices[after]
            if best is None or offer < best:
                best, to = offer, after
        if prices[node] < best:
            prices[node] = best
            if node != origin:
                path.pop()
        else:
            path.append(to)
    return prices[origin]


def _least_tight(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int) -> tuple[str, int]:
    """The ASCII-least string over the tight paths from `origin` to the end, and the last node of it.

    Arcs are tried in the order of their letters; a node without a tight way to the end is left for good.
    """
    end, path, letters = len(arcs), [origin], [""]
    tried = {origin: iter(arcs[origin])}
    while True:
        node = path[-1]
        for letter, after, cost in tried[node]:
            if prices[node] == cost + prices[after]:
                if after == end:
                    return "".join(letters), node
                if after not in tried:
                    tried[after] = iter(arcs[after])
                    path.append(after)
                    letters.append(letter)
                    break
        else:
            path.pop()
            letters.pop()


@lru_cache(maxsize=4096)
def _cross(rows: bytes, exits: tuple[int | None, ...], last: bool, state: int) -> tuple[int, str, int]:
    """(length, letters, state behind the rows) of the best way through a stretch."""
    arcs = _arcs(rows, exits, last)
    prices = [0] * (len(arcs) + 1)
    length = auction(arcs, prices, state)
    letters, node = _least_tight(arcs, prices, state)
    return length, letters, node & 3


@lru_cache(maxsize=4096)
def _entries(rows: bytes, exits: tuple[int | None, ...], last: bool) -> tuple[int, ...]:
    """The exact prices of the four states in front of a stretch."""
    arcs = _arcs(rows, exits, last)
    prices = [0] * (len(arcs) + 1)
    return tuple(auction(arcs, prices, state) for state in range(4))


def repair(rows: bytes, stretch: int = STRETCH) -> tuple[int, str]:
    """(cost, letters) of the cheapest repair of a conversation's rows, the ASCII-least if there are several.

    Prices behind a stretch are counted from the lowest of them, so no auction has to raise prices
    by what the stretches behind it cost.
    """
    starts = range(0, len(rows), stretch) or [0]
    exits: list[tuple[int | None, ...]] = [COMPLETE]
    cost = 0
    for at in reversed(starts[1:]):
        prices = _entries(rows[at : at + stretch], exits[-1], len(exits) == 1)
        cost += min(prices)
        exits.append(tuple(p - min(prices) for p in prices))
    state, letters = START, []
    for at in starts:
        behind = exits.pop()
        length, found, state = _cross(rows[at : at + stretch], behind, not exits, state)
        cost += 0 if at else length
        letters.append(found)
    return cost, "".join(letters)


class _Findings:
    """What is found while a conversation's rows pass by."""

    def __init__(self, row: tuple, stretch: int):
        self.conv, self.stretch = row[0], stretch
        self.codes = bytearray()
        self.first = self.last = self.before = self.initial = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, row: tuple) -> None:
        _, there, turn, role, digest, again, blank, finished = row
        if not there:
            return
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.turns, self.last = self.turns + 1, turn
        again = again or self.before == (turn, role, digest)
        self.before = turn, role, digest
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        fault = BLANK if blank else DUPLICATE if again else 0 if finished else TRUNCATED
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == TRUNCATED
        self.codes.append(code_of(initial, fault))

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, letters = repair(bytes(self.codes), self.stretch)
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, letters


class _Rewriting:
    """The digest of a conversation whose rows pass by, edited by the letters of the row before them."""

    def __init__(self, row: tuple):
        self.conv, self.head, self.letters = row[0], row[:-3], row[-4]
        self.at, self.state, self.some = 0, START, False
        self.hash = hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.hash.update(("\n" * self.some + f"{role}:{text}").encode())
        self.some = True

    def _insert(self) -> None:
        while self.letters[self.at : self.at + 1] == "I":
            self.state, self.at = WANTED[self.state], self.at + 1
            self._write(ROLE_OF[self.state], "")

    def add(self, row: tuple) -> None:
        part, role, text = row[-3:]
        if part == 0:
            return
        self._insert()
        letter, self.at = self.letters[self.at], self.at + 1
        if letter == "K":
            self.state = KEPT[self.state][role[:1]]
            self._write(role, text)
        elif letter == "R":
            self.state = WANTED[self.state]
            self._write(ROLE_OF[self.state], text)

    def result(self) -> tuple:
        self._insert()
        return *self.head, self.hash.hexdigest()


def _folded(
    batches: Iterator[pa.RecordBatch],
    start: Callable[[tuple], _Findings | _Rewriting],
    names: list[str],
    types: list[pa.DataType],
) -> Iterator[pa.RecordBatch]:
    """One result for each run of rows with the same first column, which may go on in the next batch."""
    held, done = None, []

    def packed() -> pa.RecordBatch:
        columns = zip(*done) if done else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held is None or held.conv != row[0]:
                if held is not None:
                    done.append(held.result())
                held = start(row)
            held.add(row)
        yield packed()
        done = []
    if held is not None:
        done = [held.result()]
        yield packed()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
COUNT_TYPES = ", ".join(f"{c} bigint" for c in COUNTS)


def _plain(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(" "))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv").sortWithinPartitions("conv", *first, "turn", "role", "digest")


def find_faults(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of rows (conv, there, turn, role, text, digest).

    Rows that are not `there` only name their conversation.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    same = F.md5(F.concat_ws("\x00", F.col("conv").isNull().cast("string"), _plain(F.col("conv")), "role", "digest"))
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    narrow = rows.select(
        "conv",
        "there",
        "turn",
        "role",
        "digest",
        same.alias("same"),
        (F.col("there") & (trimmed == "")).alias("blank"),
        F.right(trimmed, F.lit(1)).isin(".", "!", "?").alias("finished"),
    )
    narrow = checkpoint(narrow)
    held = narrow.filter("there").groupBy("same").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n"))
    held = checkpoint(held.filter("n > 1"))
    marked = lookup_join(narrow, held.select("same", "first"), ["same"], ["turn"], "left", (held.select("same", "n"), "n"))
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    marked = marked.withColumn("again", later)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _folded(batches, lambda row: _Findings(row, stretch), ["conv", *COUNTS, "audit"], types)

    ship(rows.sparkSession)
    types = [to_arrow_type(rows.schema["conv"].dataType), *[pa.int64()] * len(COUNTS), pa.string()]
    streamed = marked.select("conv", "there", "turn", "role", "digest", "again", "blank", "finished")
    return _in_order(streamed).mapInArrow(scan, f"conv {kind}, {COUNT_TYPES}, audit string")


def rewrite(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`found` with repaired_sha256, the digest of the repaired `role:text` lines."""
    kind = rows.schema["conv"].dataType.simpleString()
    texts = rows.filter("there").select(
        "conv",
        F.lit(1).alias("part"),
        "turn",
        "role",
        "digest",
        "text",
        F.lit(None).cast("string").alias("audit"),
        *[F.lit(None).cast("bigint").alias(c) for c in COUNTS],
    )
    heads = found.select(
        "conv",
        F.lit(0).alias("part"),
        F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("digest"),
        F.lit(None).cast("string").alias("text"),
        "audit",
        *COUNTS,
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _folded(batches, _Rewriting, ["conv", *COUNTS, "audit", "repaired_sha256"], types)

    ship(rows.sparkSession)
    types = [to_arrow_type(rows.schema["conv"].dataType), *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
    ordered = _in_order(heads.unionByName(texts), "part").select("conv", *COUNTS, "audit", "part", "role", "text")
    return ordered.mapInArrow(scan, f"conv {kind}, {COUNT_TYPES}, audit string, repaired_sha256 string")


def _prepared(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.md5(F.col("text").cast("binary")))


def repair_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", stretch: int = STRETCH
) -> DataFrame:
    """One row per conversation: conv, the counts of faults, the cost, the edits and the digest of the repaired rows."""
    rows = turns.select(
        quoted(conv).alias("conv"),
        F.lit(True).alias("there"),
        quoted(turn).alias("turn"),
        _plain(quoted(role)).alias("role"),
        _plain(quoted(text)).alias("text"),
    )
    rows = _prepared(rows)
    return rewrite(rows, checkpoint(find_faults(rows, stretch)))


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage, chosen by a hash of each row's id; dropped rows stay as names of their conversation."""
    choice = F.crc32(F.concat(_plain(F.col("conv_id")), F.lit(":"), _plain(F.col("turn")))) % 20
    rows = turns.select(
        F.col("conv_id").alias("conv"),
        "turn",
        choice.alias("choice"),
        _plain(F.col("role")).alias("role"),
        _plain(F.col("text")).alias("text"),
    )
    text = F.when(F.col("choice") == 1, "").when(F.col("choice") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("choice") == 3, 2).otherwise(1))
    return _prepared(
        rows.select(
            "conv",
            (F.col("choice") != 0).alias("there"),
            "turn",
            F.when(F.col("choice") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.explode(copies).alias("copy"),
        ).drop("copy")
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(turns)
    done = rewrite(rows, checkpoint(find_faults(rows)))
    return done.select(F.col("conv").alias("conv_id"), *COUNTS, "audit", "repaired_sha256")


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLE = {
    "op12_conversation_repair": f"""
        WITH RECURSIVE octets AS (SELECT unnest(range(256)) AS b),
        bits AS (
            SELECT b, 0 AS k, b AS v FROM octets
            UNION ALL SELECT b, k + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END) FROM bits WHERE k < 8),
        step AS (SELECT b, v FROM bits WHERE k = 8),
        given AS (
            SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS k,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
            FROM conversations),
        -- The checksum of a name, one character after the other.
        crc AS (
            SELECT name, 0 AS at_char, 4294967295 AS v FROM (SELECT DISTINCT name FROM given)
            UNION ALL
            SELECT name, at_char + 1, xor(crc.v >> 8, step.v)
            FROM crc JOIN step ON step.b = xor(crc.v & 255, ascii(substr(name, at_char + 1, 1))) WHERE at_char < length(name)),
        choices AS (SELECT name, xor(4294967295, v) % 20 AS choice FROM crc WHERE at_char = length(name)),
        damaged AS (
            SELECT k, turn, CASE WHEN choice = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                   CASE choice WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '')
                               ELSE coalesce(text, ' ') END AS text,
                   unnest(CASE WHEN choice = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM given JOIN choices USING (name) WHERE choice <> 0),
        numbered AS (
            SELECT *, left(role, 1) AS initial,
                   row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
                   row_number() OVER (PARTITION BY k, role, text ORDER BY turn NULLS FIRST, copy) AS seen
            FROM damaged),
        faulty AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN seen > 1 THEN 2
                           WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 3 ELSE 0 END AS fault,
                   lag(initial) OVER (PARTITION BY k ORDER BY i) || initial AS pair
            FROM numbered),
        counts AS (
            SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                   count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faulty GROUP BY k),
        wanted(q, next, wanted_role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
        kept(q, initial, next) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        inserts AS (
            SELECT q, q AS mid, 0 AS cost, '' AS letters, '' AS lines FROM wanted
            UNION ALL SELECT q, next, {INSERT}, 'I', chr(10) || wanted_role || ':' FROM wanted
            UNION ALL SELECT a.q, b.next, {2 * INSERT}, 'II', chr(10) || a.wanted_role || ':' || chr(10) || b.wanted_role || ':'
                      FROM wanted a JOIN wanted b ON b.q = a.next),
        -- All ways over one row from each state.
        ways AS (
            SELECT k, i, s.q, s.mid AS next, s.cost + {DELETE} AS cost, letters || 'D' AS letters, lines
            FROM faulty, inserts s
            UNION ALL
            SELECT k, i, s.q, kept.next, s.cost + CASE WHEN fault = 3 THEN {UNFINISHED} ELSE 0 END, letters || 'K',
                   lines || chr(10) || role || ':' || text
            FROM faulty, inserts s JOIN kept ON kept.q = s.mid WHERE kept.initial = faulty.initial AND fault NOT IN (1, 2)
            UNION ALL
            SELECT k, i, s.q, w.next, s.cost + {RENAME} + CASE WHEN fault = 3 THEN {UNFINISHED} ELSE 0 END, letters || 'R',
                   lines || chr(10) || w.wanted_role || ':' || text
            FROM faulty, inserts s JOIN wanted w ON w.q = s.mid WHERE fault NOT IN (1, 2)),
        best AS (
            SELECT DISTINCT k, CAST(0 AS BIGINT) AS i, 0 AS q, {{'cost': 0, 'letters': '', 'lines': ''}} AS b FROM given
            UNION ALL
            SELECT best.k, ways.i, ways.next, min({{'cost': b.cost + ways.cost, 'letters': b.letters || ways.letters,
                                                   'lines': b.lines || ways.lines}})
            FROM best JOIN ways ON ways.k = best.k AND ways.i = best.i + 1 AND ways.q = best.q
            GROUP BY best.k, ways.i, ways.next),
        ended AS (
            SELECT best.k, min({{'cost': b.cost + s.cost, 'letters': b.letters || s.letters, 'lines': b.lines || s.lines}}) AS b
            FROM best JOIN inserts s ON s.q = best.q LEFT JOIN counts ON counts.k = best.k
            WHERE i = coalesce(n, 0) AND s.mid IN (0, 3) GROUP BY best.k)
        SELECT DISTINCT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(b.cost AS BIGINT) AS cost,
               b.letters AS audit, sha256(substr(b.lines, 2)) AS repaired_sha256
        FROM given JOIN ended USING (k) LEFT JOIN counts USING (k)
    """
}

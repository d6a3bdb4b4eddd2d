"""Conversation structure repair: Viterbi with survivors that coalesce.

A conversation's rows are kept, given another role or deleted, at the least cost that leaves roles of the form (s?(ua)+)? by
their initials. The search goes forward over the rows with four states (nothing yet, after s, after u, after a). Its back
pointers form a tree with reference counts: a branch that no state needs goes at once, and as soon as all survivors share an
ancestor, the edits up to it are settled, handed out and forgotten. So memory holds what is unsettled only. Two equally cheap
ways into a state are told apart by their complete unsettled edits, from where they part.

An insert (of an empty user or assistant turn) is an edit too, but it is never part of a cheapest repair while it costs more than
two deletions: take the pair u, a that it belongs to. Without the insert, with the pair's other row deleted, and with the s before it
deleted if that was the only pair, the form holds, at a cost lower by at least one insert less two deletions. Costs where that
doesn't hold are refused, so all strings of edits are as long as their rows.

A long conversation is cut into slices. Each slice is searched from every state it could begin in, wherever it lies, and a second search of the same kind
goes over the slices, whose label is a whole string of edits. Only this one, and the digest of the repaired text, run through a conversation in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, quoted, table

INK = re.compile(r"[^\x20\x09-\x0D]")
CLOSED = ".!?"
#: The states, in which a repair may end, and where the initial of a kept row leads.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (NOTHING, AFTER_A)
KEEPS = {"s": ((NOTHING, AFTER_S),), "u": ((NOTHING, AFTER_U), (AFTER_S, AFTER_U), (AFTER_A, AFTER_U)), "a": ((AFTER_U, AFTER_A),)}
REROLES = KEEPS["u"] + KEEPS["a"]
ADJACENT = ("su", "ua", "au")
#: Code points of role and text by which rows of the same turn are ordered before they are by hash.
ORDERED_CHARS = 200
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


@dataclass(frozen=True)
class Costs:
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if min(self.keep, self.rerole, self.delete, self.truncated) < 0 or self.insert <= 2 * self.delete:
            raise ValueError("costs must not be negative, and an insert must cost more than two deletions")

    def gaps(self) -> dict[tuple[int, int], int]:
        """(s, t): what continuing from t may cost more than from s at most, so that s is out if it is dearer than t by more."""
        return {(NOTHING, AFTER_A): self.delete, (AFTER_S, AFTER_A): 0, (AFTER_S, AFTER_U): self.delete}

    def moves(self, initial: str, fault: str | None) -> list[tuple[int, int, int, str]]:
        """(from, to, cost, edit) of a row."""
        out = [(s, s, self.delete, "D") for s in range(4)]
        if fault in ("blank", "duplicate"):
            return out
        more = self.truncated if fault == "truncated" else 0
        out += [(s, t, self.keep + more, "K") for s, t in KEEPS.get(initial, ())]
        return out + [(s, t, self.rerole + more, "R") for s, t in REROLES]


class Node:
    """An edit, or the edits of a slice, behind its parent's. refs counts child nodes, and states that it is the last edit of."""

    __slots__ = ("parent", "label", "item", "refs")

    def __init__(self, parent: Node | None, label: str, item):
        self.parent, self.label, self.item, self.refs = parent, label, item, 0
        if parent is not None:
            parent.refs += 1


class Survivors:
    """The cheapest way into each state, as a tree of what is not settled yet; settled items go to emit(label, item) in order."""

    def __init__(self, start: int, emit: Callable[[str, object], None] | None = None, gaps: dict[tuple[int, int], int] | None = None):
        self.emit, self.gaps = emit, gaps or {}
        self.root = Node(None, "", None)
        self.root.refs = 1
        self.best: dict[int, tuple[int, Node]] = {start: (0, self.root)}

    @staticmethod
    def less(a: Node, x: str, b: Node, y: str) -> bool:
        """Whether a's edits and then x come before b's and then y: both complete, from where they part."""
        xs, ys = [x], [y]
        while a is not b:  # equally deep, as all are extended at once
            xs.append(a.label)
            ys.append(b.label)
            a, b = a.parent, b.parent
        return "".join(reversed(xs)) < "".join(reversed(ys))

    def step(self, moves: list[tuple[int, int, int, str]], item) -> None:
        chosen: dict[int, tuple[int, Node, str]] = {}
        for s, t, cost, label in moves:
            if s not in self.best:
                continue
            total, node = self.best[s][0] + cost, self.best[s][1]
            old = chosen.get(t)
            if old is None or total < old[0] or (total == old[0] and self.less(node, label, old[1], old[2])):
                chosen[t] = (total, node, label)
        for (s, t), gap in self.gaps.items():
            if s in chosen and t in chosen and chosen[s][0] > chosen[t][0] + gap:
                del chosen[s]
        last, self.best = self.best, {t: (cost, Node(node, label, item)) for t, (cost, node, label) in chosen.items()}
        for _, node in self.best.values():
            node.refs += 1
        for _, node in last.values():
            self._release(node)
        if self.emit is not None:
            self._settle()

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            node = node.parent
            node.refs -= 1

    def _settle(self) -> None:
        """Hands out what all survivors share, and makes the last of it the root."""
        if self.root.refs != 1:
            return
        leaf = next(iter(self.best.values()))[1]
        path, node = [], leaf
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self.emit(node.label, node.item)
            node.parent, self.root = None, node
            if node.refs != 1 or node is leaf:
                return

    def path(self, state: int) -> tuple[str, list]:
        """The unsettled edits into a state and their items."""
        labels, items, node = [], [], self.best[state][1]
        while node is not self.root:
            labels.append(node.label)
            items.append(node.item)
            node = node.parent
        return "".join(reversed(labels)), items[::-1]

    def end(self) -> int:
        """Settles the cheapest way into a state that may end it, of equal ones the first by edits; its cost."""
        ends = [s for s in ENDS if s in self.best]
        best = ends[0]
        for s in ends[1:]:
            (cost, node), (least, other) = self.best[s], self.best[best]
            if cost < least or (cost == least and self.less(node, "", other, "")):
                best = s
        cost, leaf = self.best[best]
        path, node = [], leaf
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self.emit(node.label, node.item)
        return cost


class Repaired:
    """The audit and the digest of the repaired conversation, of edits that are handed out in order."""

    def __init__(self):
        self.audit: list[str] = []
        self.sha, self.any, self.turn = hashlib.sha256(), False, "user"

    def rows(self, label: str, rows) -> None:
        """label has an edit for each of rows (role, text)."""
        self.audit.append(label)
        for edit, (role, text) in zip(label, rows, strict=True):
            if edit == "D":
                continue
            role = self.turn if edit == "R" else role
            self.turn = "assistant" if role[:1] == "u" else "user"
            self.sha.update((("\n" if self.any else "") + role + ":" + text).encode())
            self.any = True

    def row(self, edit: str, row) -> None:
        self.rows(edit, (row,))


def faults(rows: list[tuple[str, str]], seen: set) -> list[str | None]:
    """The first fault of each row; seen are the rows that earlier slices had, and gets these."""
    out = []
    for role, text in rows:
        key = (role, text)
        body = text.rstrip(" \t\n\r\x0b\x0c")
        out.append("blank" if not body else "duplicate" if key in seen else "truncated" if body[-1] not in CLOSED else None)
        seen.add(key)
    return out


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ADJACENT for a, b in zip(initials, initials[1:]))


def repaired_row(conv_id, rows: list[tuple[str, str]], turns: list[int | None], costs: Costs) -> tuple:
    """The result for a whole conversation."""
    kinds, out = faults(rows, set()), Repaired()
    search = Survivors(NOTHING, out.row, costs.gaps())
    for row, kind in zip(rows, kinds, strict=True):
        search.step(costs.moves(row[0][:1], kind), row)
    cost = search.end()
    known = [t for t in turns if t is not None]
    gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
    count = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    return (conv_id, gaps, *count, illegal([r[:1] for r, _ in rows]), cost, "".join(out.audit), out.sha.hexdigest())


def ordered(messages: DataFrame, there: Column) -> DataFrame:
    """Rows in order of conversation and turn over all partitions. A long conversation lies in several, and so do equal rows.

    Of the same turn: by role, then by text, by their first ORDERED_CHARS code points and then by hash, as the keys that Spark samples must be short. The random
    number is the last key, it parts equal rows only.
    """
    rows = messages.select("conv_id", "turn", F.when(there, F.coalesce("role", F.lit(" "))).alias("role"), F.when(there, F.coalesce("text", F.lit(" "))).alias("text"), there.alias("there"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.left("role", F.lit(ORDERED_CHARS)), F.left("text", F.lit(ORDERED_CHARS)), F.xxhash64("role", "text"), F.col("part")]
    return rows.withColumn("part", F.rand(7)).repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "turn", "role", "text", "there")


SLICES = "conv_id long, part int, at int, edge boolean, turns array<long>, roles array<string>, texts array<string>"


def sliced(rows: DataFrame) -> DataFrame:
    """Runs of a conversation's rows in an Arrow batch, as one row each. Those at a batch's ends (edge) may be pieces of a conversation; others are whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            if not b.num_rows:
                continue
            ids, there = b.column(0), b.column(4)
            void = ids.is_null().to_numpy(zero_copy_only=False)
            number = ids.fill_null(0).to_numpy(zero_copy_only=False)
            new = np.flatnonzero((number[1:] != number[:-1]) | (void[1:] != void[:-1])) + 1
            starts = np.concatenate([[0], new])
            present = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
            offsets = pa.array(np.concatenate([present[starts], present[-1:]]).astype(np.int32))
            n = len(starts)
            edge = np.zeros(n, bool)
            edge[[0, -1]] = True
            lists = [pa.ListArray.from_arrays(offsets, b.column(k).filter(there)) for k in (1, 2, 3)]
            head = [ids.take(pa.array(starts)), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n, dtype=np.int32)), pa.array(edge)]
            at += n
            yield pa.RecordBatch.from_arrays(head + lists, ["conv_id", "part", "at", "edge", "turns", "roles", "texts"])

    return rows.mapInArrow(run, SLICES)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_L, _S = pa.int64(), pa.string()
_RESULT = pa.schema([("conv_id", _L), ("gaps", _L), ("blank", _L), ("duplicate", _L), ("truncated", _L), ("illegal", _L), ("cost", _L), ("audit", _S), ("repaired_sha256", _S)])
_WAY = pa.struct([("s", pa.int32()), ("t", pa.int32()), ("cost", _L), ("label", _S)])
_SEARCHED = pa.schema([("conv_id", _L), ("part", pa.int32()), ("at", pa.int32()), ("blank", _L), ("duplicate", _L), ("truncated", _L), ("illegal", _L), ("first", _S), ("last", _S), ("low", _L), ("high", _L), ("turns", _L), ("ways", pa.list_(_WAY)), ("roles", pa.list_(_S)), ("texts", pa.list_(_S))])
SEARCHED = "conv_id long, part int, at int, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long, ways array<struct<s:int,t:int,cost:long,label:string>>, roles array<string>, texts array<string>"


def whole_ones(slices: DataFrame, costs: Costs) -> DataFrame:
    """Results of slices that are whole conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([repaired_row(r["conv_id"], list(zip(r["roles"], r["texts"], strict=True)), r["turns"], costs) for r in b.to_pylist()], _RESULT)

    return slices.select("conv_id", "turns", "roles", "texts").mapInArrow(run, RESULT)


def _said(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def seen_before(slices: DataFrame) -> DataFrame:
    """(part, at, seen): for each slice the digests of its rows that an earlier slice of the conversation has too.

    Slices bring each digest once, so a row that is said a million times counts as often as it has slices.
    """
    said = F.array_distinct(F.transform(F.arrays_zip("roles", "texts"), lambda x: _said(x["roles"], x["texts"])))
    each = slices.select("conv_id", F.struct("part", "at").alias("slice"), F.explode(said).alias("digest"))
    keys = [F.coalesce("conv_id", F.lit(0)).alias("c"), F.col("conv_id").isNull().alias("void"), "digest"]
    each = each.select(*keys, "slice")
    first = each.groupBy("c", "void", "digest").agg(F.min("slice").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = each.join(first, ["c", "void", "digest"]).filter(F.col("slice") > F.col("first"))
    return later.groupBy("slice").agg(F.collect_list("digest").alias("seen")).select("slice.part", "slice.at", "seen")


def searched(slices: DataFrame, costs: Costs) -> DataFrame:
    """Each slice, with the digests seen before it, searched from every state: ways (from, to, cost, edits)."""

    def one(r: dict) -> tuple:
        rows = list(zip(r["roles"], r["texts"], strict=True))
        digest = lambda row: hashlib.sha256(f"{len(row[0])}:{row[0]}{row[1]}".encode()).digest()
        before = set(r["seen"] or ())
        kinds = faults(rows, {row for row in rows if digest(row) in before} if before else set())
        steps = [costs.moves(role[:1], kind) for (role, _), kind in zip(rows, kinds, strict=True)]
        ways = []
        for s in range(4):
            search = Survivors(s, None, costs.gaps())
            for moves in steps:
                search.step(moves, None)
            ways += [{"s": s, "t": t, "cost": cost, "label": search.path(t)[0]} for t, (cost, _) in search.best.items()]
        known = [t for t in r["turns"] if t is not None]
        initials = [role[:1] for role, _ in rows]
        ends = (initials[0], initials[-1]) if rows else (None, None)
        span = (known[0], known[-1]) if known else (None, None)
        count = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        return (r["conv_id"], r["part"], r["at"], *count, illegal(initials), *ends, *span, len(set(known)), ways, r["roles"], r["texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield _batch([one(r)], _SEARCHED)

    return slices.select("conv_id", "part", "at", "turns", "roles", "texts", "seen").mapInArrow(run, SEARCHED)


class Chain:
    """A conversation's slices in order."""

    def __init__(self, conv_id, costs: Costs):
        self.conv_id, self.out = conv_id, Repaired()
        self.search = Survivors(NOTHING, self.out.rows, costs.gaps())
        self.sums, self.last, self.low, self.high, self.turns, self.broken = [0, 0, 0], None, None, None, 0, 0

    def add(self, r: dict) -> None:
        if r["first"] is None:
            return
        self.search.step([(w["s"], w["t"], w["cost"], w["label"]) for w in r["ways"]], list(zip(r["roles"], r["texts"], strict=True)))
        self.sums = [a + r[k] for a, k in zip(self.sums, ("blank", "duplicate", "truncated"), strict=True)]
        self.broken += r["illegal"] + (self.last is not None and self.last + r["first"] not in ADJACENT)
        self.last = r["last"]
        if r["low"] is not None:
            self.turns += r["turns"] - (r["low"] == self.high)
            self.low, self.high = r["low"] if self.low is None else self.low, r["high"]

    def row(self) -> tuple:
        cost = self.search.end()
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return (self.conv_id, gaps, *self.sums, self.broken, cost, "".join(self.out.audit), self.out.sha.hexdigest())


def chained(slices: DataFrame, costs: Costs) -> DataFrame:
    """Results of conversations in slices: read in order, a slice at a time. Texts of slices whose edits are settled are digested and forgotten."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                if now is None or now.conv_id != r["conv_id"]:
                    if now is not None:
                        yield _batch([now.row()], _RESULT)
                    now = Chain(r["conv_id"], costs)
                now.add(r)
        if now is not None:
            yield _batch([now.row()], _RESULT)

    return slices.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "at").mapInArrow(run, RESULT)


def repair(messages: DataFrame, there: Column | None = None, costs: Costs = Costs(), room: Scratch | None = None) -> DataFrame:
    """One row for each conv_id of messages(conv_id, turn, role, text): its faults, the cheapest repair's cost and edits, and the digest of the repaired rows.

    Rows go by turn, nulls first; of the same turn by role and text. A null role or text is a space. A null conv_id is a conversation of its own. Rows of which there is not
    true say only that the conversation exists. A row's first fault counts: blank, duplicate (of a row with its role and text, wherever it stands before),
    truncated. gaps are the turns missing between the least and the greatest, illegal the neighbours whose initials are not su, ua or au. A conversation without rows has zeros, no edits and the
    digest of nothing. Very long texts are taken whole; repeated rows are duplicates; an empty table gives none; other columns are not read.
    """
    room = room or Scratch(messages.sparkSession)
    bounded_batches(messages.sparkSession)
    there = F.lit(True) if there is None else F.coalesce(there, F.lit(False))
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), quoted("role").cast("string").alias("role"), quoted("text").cast("string").alias("text"), there.alias("_there"))
    slices = room.keep(sliced(ordered(rows, F.col("_there"))), "slices")
    edges = slices.filter("edge")
    known = edges.join(seen_before(edges), ["part", "at"], "left")
    return whole_ones(slices.filter("not edge"), costs).unionByName(chained(searched(known, costs), costs))


def damage(rows: DataFrame) -> DataFrame:
    """Damages rows(conv_id, turn, role, text) by the checksum of '<conv_id>:<turn>' modulo 20; dropped rows stay, with there false."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(blank("text"), CLOSED, "")).otherwise(blank("text"))
    role = F.when(kind == 4, "user").otherwise(blank("role"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("there"), F.explode(copies).alias("copy")).drop("copy")


def op12_survivor_coalescence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return repair(damage(table(spark, sf_dir, "conversations")), F.col("there"))


#: CRC-32 in SQL: the table of a byte's remainders (from its polynomial), then a text's bytes.
CRC_TABLE_SQL = "crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"


def crc_sql(text: str) -> str:
    octets = f"list_transform(range(length(hex(encode({text}))) // 2), lambda nth: CAST('0x' || substr(hex(encode({text})), 2 * nth + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


def _way(state: str, cost: str, edit: str) -> str:
    return f"{{'c': v.{state}.c + {cost}, 'a': v.{state}.a || '{edit}'}}"


def _best(state: str, keep: str | None, keep_from: str, role_from: str) -> str:
    """SQL of the cheapest way into a state; a missing one costs a billion."""
    ways = [_way(state, "2", "D")]
    ways += [f"CASE WHEN g AND i = '{keep}' THEN {_way(s, 'm', 'K')} ELSE {_way(state, '1000000000', 'D')} END" for s in keep_from.split()]
    ways += [f"CASE WHEN g THEN {_way(s, 'm + 1', 'R')} ELSE {_way(state, '1000000000', 'D')} END" for s in role_from.split()]
    return f"list_min([{', '.join(ways)}])" if len(ways) > 1 else ways[0]


_KIND = crc_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')") + " % 20"
_FAR = "{'c': CAST(1000000000 AS BIGINT), 'a': ''}"
_SPACES = "'[^\\x20\\x09-\\x0D]'"
OP12_SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL}, k AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_KIND} AS kind FROM conversations, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM k WHERE kind <> 0
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos, left(role, 1) AS i FROM damaged
), faulty AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, {_SPACES}) THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault,
        lag(i) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM numbered
), cases AS (
    SELECT *, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS g, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS m FROM faulty
), v AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS pos, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS n, {_FAR} AS s, {_FAR} AS u, {_FAR} AS a FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT v.conv_id, v.pos + 1, {_best("n", None, "", "")}, {_best("s", "s", "n", "")}, {_best("u", "u", "n s a", "n s a")}, {_best("a", "a", "u", "u")}
    FROM v JOIN cases ON v.conv_id IS NOT DISTINCT FROM cases.conv_id AND cases.pos = v.pos + 1
), ends AS (
    SELECT conv_id, list_min([n, a]) AS best FROM v QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1
), left_over AS (
    SELECT conv_id, cases.pos, role, text, i, substr(best.a, CAST(cases.pos AS BIGINT), 1) AS edit FROM cases JOIN ends USING (conv_id) WHERE substr(best.a, CAST(cases.pos AS BIGINT), 1) <> 'D'
), placed AS (
    SELECT *, row_number() OVER w - CASE WHEN first_value(i) OVER w = 's' AND first_value(edit) OVER w = 'K' THEN 1 ELSE 0 END AS place
    FROM left_over WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS said FROM placed GROUP BY conv_id
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM cases GROUP BY conv_id
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM ends LEFT JOIN counts USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""

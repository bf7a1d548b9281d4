"""Repair of conversations whose turns don't alternate, by shortest paths under scalar weights.

A repaired conversation has the roles of ``(s?(ua)+)?``: nothing, or a system turn perhaps and then user and assistant in
turn. Each row is kept, deleted or given another role, and empty rows may be put in between; each edit has a cost and an
initial. Of the cheapest repairs, the one whose initials come first in ASCII order is taken.

Both are decided by one integer a path. The rows read, the rows put in and the last role are a node of an acyclic graph,
an edit is an edge, and a path's weight is a plain sum: the cost in the high digits, and in base 8 the initial of the
k-th edit at the k-th of a fixed number of places, from the left. Places after the last edit stay zero, so a list of
edits that another one begins with is the smaller one. Taking the smaller integer at each node is the whole algorithm.

A conversation of any length is worked on in pages of some hundred rows. All rows are put in one order, in which ranges
are dealt out, so that one conversation with a third of all rows is spread over many tasks. A page solves what begins and
ends inside it. Of what crosses its border it gives the best weights from each role to each role; these are a coarser
graph of the same kind, whose best path gives each page its edits. The digest of a repaired conversation is taken over
its rows in order, by a task that reads them as a stream and holds one of them at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.common import crc_mod, written

PAGE = 512  # rows
BITS = 3  # of an initial
INITIALS = {"D": 1, "I": 2, "K": 3, "R": 4}  # in ASCII order
LETTERS = str.maketrans("1234", "DIKR")
BEGIN, SYSTEM, USER, ASSISTANT = range(4)  # the last role so far
ENDS = (BEGIN, ASSISTANT)
NEXT = {("s", BEGIN): SYSTEM, ("u", BEGIN): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
PARTS = 33  # monotonically_increasing_id keeps a row's number in its partition in the lower 33 bits


class Costs(NamedTuple):
    """What an edit costs, and what a truncated row that isn't deleted adds."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def most_inserts(self, rows: int) -> int:
        """How many rows the cheapest repair may put in.

        None, if one costs more than two deletions: take the pair of user and assistant that it is in out again. Its
        other row is put in as well, or is deleted instead; if no pair is left, a system row is deleted, too. That saves
        an insertion for two deletions at most. Else one beside each row, and a pair after a system row.
        """
        return 0 if self.insert > 2 * self.delete else rows + 2


class Row(NamedTuple):
    initial: str
    fault: str | None  # blank, duplicate, truncated


Paths = dict[tuple[int, int], int]  # (last role, rows put in) -> weight


def paths(rows: list[Row], start: int, costs: Costs, most: int) -> Paths:
    """The smallest weight from ``start`` to each node after all rows. Of a path with j rows put in, the initials take
    len(rows) + j places."""
    places = len(rows) + most
    unit = 1 << BITS * places
    now: Paths = {(start, 0): 0}

    def offer(to: Paths, node: tuple[int, int], weight: int) -> None:
        if node not in to or weight < to[node]:
            to[node] = weight

    for i in range(len(rows) + 1):
        for j in range(most):
            mark = costs.insert * unit + (INITIALS["I"] << BITS * (places - 1 - i - j))
            for initial in ROLES:
                for state in range(4):
                    if (state, j) in now and (initial, state) in NEXT:
                        offer(now, (NEXT[initial, state], j + 1), now[state, j] + mark)
        if i == len(rows):
            break
        row, after = rows[i], {}
        stay = costs.truncated if row.fault == "truncated" else 0
        for (state, j), weight in now.items():
            at = BITS * (places - 1 - i - j)
            offer(after, (state, j), weight + costs.delete * unit + (INITIALS["D"] << at))
            if row.fault in ("blank", "duplicate"):
                continue
            if (row.initial, state) in NEXT:
                offer(after, (NEXT[row.initial, state], j), weight + stay * unit + (INITIALS["K"] << at))
            for initial in ROLES:
                if (initial, state) in NEXT:
                    offer(after, (NEXT[initial, state], j), weight + (stay + costs.rerole) * unit + (INITIALS["R"] << at))
        now = after
    return {(state, j): weight >> BITS * (most - j) for (state, j), weight in now.items()}


def joined(one: int, places: int, two: int, more: int) -> int:
    """The weight of a path whose initials take ``places`` and one after it whose initials take ``more``."""
    cost, initials = two >> BITS * more, two & ((1 << BITS * more) - 1)
    return (one << BITS * more) + (cost << BITS * (places + more)) + initials


def letters(weight: int, places: int) -> str:
    """The initials of a weight's path."""
    return f"{weight & ((1 << BITS * places) - 1):o}".zfill(places).translate(LETTERS) if places else ""


def smallest(ends: Paths, rows: int) -> tuple[int, int]:
    """The accepted node whose weight is smallest when all have the same number of places."""
    most = max(j for _, j in ends)
    return min((node for node in ends if node[0] in ENDS), key=lambda node: ends[node] << BITS * (most - node[1]))


def solved(rows: list[Row], costs: Costs) -> tuple[int, str]:
    """Cost and edits of the best repair."""
    ends = paths(rows, BEGIN, costs, costs.most_inserts(len(rows)))
    state, j = smallest(ends, len(rows))
    places = len(rows) + j
    return ends[state, j] >> BITS * places, letters(ends[state, j], places)


class Facts(NamedTuple):
    """What is counted in rows that stand one after the other."""

    low: int | None  # turns
    high: int | None
    turns: int  # distinct ones
    blank: int
    duplicate: int
    truncated: int
    illegal: int

    @classmethod
    def of(cls, rows: list[Row], turns: list[int | None]) -> Facts:
        known = [t for t in turns if t is not None]
        faults = [r.fault for r in rows]
        return cls(known[0] if known else None, known[-1] if known else None, len(set(known)),
                   *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                   sum(a.initial + b.initial not in LEGAL for a, b in zip(rows, rows[1:])))

    def then(self, other: Facts, border: str) -> Facts:
        """Both, one after the other; ``border`` holds the initials that meet."""
        shared = self.high is not None and self.high == other.low
        return Facts(other.low if self.low is None else self.low, self.high if other.high is None else other.high,
                     self.turns + other.turns - shared, self.blank + other.blank, self.duplicate + other.duplicate,
                     self.truncated + other.truncated, self.illegal + other.illegal + (border not in LEGAL))

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


FACTS = list(Facts._fields)
PATH = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("inserts", pa.int32()), ("weight", pa.binary())])


def _schema(conv: pa.DataType) -> pa.Schema:
    """Solved conversations have their edits and cost; parts of longer ones their initials at the ends and paths."""
    return pa.schema([("conv", conv), ("at", pa.int64()), ("n", pa.int64()), ("edits", pa.string()), ("cost", pa.int64()),
                      *((f, pa.int64()) for f in FACTS), ("first", pa.string()), ("last", pa.string()),
                      ("paths", pa.list_(PATH))])


PAGES = ("conv {}, at long, n long, edits string, cost long, " + ", ".join(f"{f} long" for f in FACTS)
         + ", first string, last string, paths array<struct<start: int, end: int, inserts: int, weight: binary>>")


def _page(page: pa.Table, costs: Costs) -> pa.Table:
    """The conversations of a page: solved inside it, as parts at its ends."""
    page = page.sort_by("at")
    schema = _schema(page.schema.field("conv").type)
    columns = [page.column(c).to_pylist() for c in ("conv", "at", "turn", "initial", "fault")]
    runs = [list(run) for _, run in groupby(zip(*columns), key=lambda row: row[0])]
    out = []
    for number, run in enumerate(runs):
        rows, turns = [Row(r[3], r[4]) for r in run], [r[2] for r in run]
        facts = Facts.of(rows, turns)
        if 0 < number < len(runs) - 1:
            cost, edits = solved(rows, costs)
            out.append((*run[0][:2], len(rows), edits, cost, *facts, None, None, None))
            continue
        found = [{"start": start, "end": end, "inserts": j, "weight": w.to_bytes((w.bit_length() + 7) // 8)}
                 for start in range(4)
                 for (end, j), w in paths(rows, start, costs, costs.most_inserts(len(rows))).items()]
        out.append((*run[0][:2], len(rows), None, None, *facts, rows[0].initial, rows[-1].initial, found))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _whole(parts: pa.Table) -> pa.Table:
    """One conversation from its parts: the best path through their paths. Each part gets its edits; the first has the
    cost and the facts of all."""
    parts = parts.sort_by("at")
    schema = _schema(parts.schema.field("conv").type)
    rows = parts.to_pylist()
    now: Paths = {(BEGIN, 0): 0}
    done, back = 0, []
    for row in rows:
        after, came = {}, {}
        for path in row["paths"]:
            weight, more = int.from_bytes(path["weight"]), row["n"] + path["inserts"]
            for (state, j), before in now.items():
                if state != path["start"]:
                    continue
                node, whole = (path["end"], j + path["inserts"]), joined(before, done + j, weight, more)
                if node not in after or whole < after[node]:
                    after[node], came[node] = whole, ((state, j), letters(weight, more))
        now, done = after, done + row["n"]
        back.append(came)
    node = smallest(now, done)
    cost = now[node] >> BITS * (done + node[1])
    edits = []
    for came in reversed(back):
        node, own = came[node]
        edits.append(own)
    facts = Facts(*(rows[0][f] for f in FACTS))
    for one, two in zip(rows, rows[1:]):
        facts = facts.then(Facts(*(two[f] for f in FACTS)), one["last"] + two["first"])
    none = [None] * len(FACTS)
    out = [(row["conv"], row["at"], row["n"], own, cost if not i else None, *(facts if not i else none), None, None, None)
           for i, (row, own) in enumerate(zip(rows, reversed(edits)))]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def damage(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """id, turn, role, text after damage by the checksum of ``id:turn``: of 20 equal parts one is dropped, one loses its
    text, one its full stops, question and exclamation marks, one comes twice, and one is the user's. Nulls are read as
    one blank, but for the id and the turn themselves, which stay null. Equal rows are damaged alike."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    part = crc_mod(F.concat(blank(id_col), F.lit(":"), blank(turn_col)), 20)
    text = F.when(part == 1, F.lit("")).when(part == 2, F.regexp_replace(blank(text_col), "[.!?]", "")) \
        .otherwise(blank(text_col))
    role = F.when(part == 4, F.lit("user")).otherwise(blank(role_col))
    times = F.when(part == 0, 0).when(part == 3, 2).otherwise(1)
    return conversations.select(F.col(id_col), F.col(turn_col).cast("long").alias(turn_col), role.alias(role_col),
                                text.alias(text_col), F.explode(F.array_repeat(F.lit(0), times)).alias("_time")) \
        .drop("_time")


def in_order(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role, text and ``at``, which grows with the conversation, the turn (nulls first), the role and the
    text (its first 64 characters, then its digest); stored. Ranges of this order are dealt out, so rows of one
    conversation, of one turn, and even equal rows go to many tasks if they are many."""
    rows = conversations.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                                F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"))
    rows = rows.withColumns({"_start": F.substring("text", 1, 64), "_digest": _digest(F.col("text")),
                             "_tie": F.monotonically_increasing_id()})
    order = ["conv", "turn", "role", "_start", "_digest", "_tie"]
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_start", "_digest", "_tie")
    return written(dealt.withColumn("at", F.monotonically_increasing_id()), "in-order")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def faults(ordered: DataFrame) -> DataFrame:
    """conv, at, turn, initial, fault (the first of blank, duplicate, truncated, or null) of rows in order. The first of
    equal rows is found by a count per task and joined, so a row repeated any number of times is split."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    rows = ordered.select("conv", "at", "turn", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"),
                          cut.alias("cut"), _digest(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
                          .alias("key"))
    firsts = written(rows.filter("not blank").groupBy("conv", "key").agg(F.min("at").alias("first"), F.count("*")
                     .alias("times")).filter("times > 1").select(F.col("conv").alias("_conv"), F.col("key").alias("_key"),
                                                                 "first"), "repeated-rows")
    again = rows.join(firsts, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key")), "left")
    fault = F.when(F.col("blank"), F.lit("blank")).when(F.col("at") > F.col("first"), F.lit("duplicate")) \
        .when(F.col("cut"), F.lit("truncated"))
    return again.select("conv", "at", "turn", "initial", fault.alias("fault"))


STREAM = ["conv", "at", "kind", "edits", "cost", "gaps", "blank", "duplicate", "truncated", "illegal", "role", "text"]
COUNTED = STREAM[5:10]


def _stream(conversations: DataFrame, costs: Costs, page: int, every: DataFrame | None, id_col: str, turn_col: str,
            role_col: str, text_col: str) -> DataFrame:
    """Rows in order, each part of a conversation led by a row with its edits; ids of ``every`` come by themselves."""
    ordered = in_order(conversations, id_col, turn_col, role_col, text_col)
    conv = ordered.schema["conv"].dataType.simpleString()
    number = F.col("at").bitwiseAND(F.lit((1 << PARTS) - 1))
    rows = faults(ordered).withColumns({"part": F.shiftright("at", PARTS), "page": F.floor(number / page)})
    pages = written(rows.groupBy("part", "page").applyInArrow(lambda t: _page(t, costs), PAGES.format(conv)), "pages")
    parts = pages.filter("edits is null").groupBy("conv").applyInArrow(_whole, PAGES.format(conv))
    gaps = F.when(F.col("low").isNotNull(), F.col("high") - F.col("low") + 1 - F.col("turns")) \
        .when(F.col("cost").isNotNull(), 0)
    none = F.lit(None).cast("string")
    decided = pages.filter("edits is not null").unionByName(parts).select(
        "conv", "at", F.lit(0).alias("kind"), "edits", "cost", gaps.alias("gaps"), *COUNTED[1:], none.alias("role"),
        none.alias("text"))
    empty = [F.lit(None).cast("long").alias(c) for c in ("cost", *COUNTED)]
    out = decided.unionByName(ordered.select("conv", "at", F.lit(1).alias("kind"), none.alias("edits"), *empty, "role",
                                             "text"))
    if every is not None:
        out = out.unionByName(every.select(F.col(id_col).alias("conv")).distinct().select(
            "conv", F.lit(None).cast("long").alias("at"), F.lit(-1).alias("kind"), none.alias("edits"), *empty,
            none.alias("role"), none.alias("text")))
    return out.select(STREAM).repartition("conv").sortWithinPartitions("conv", "at", "kind")


class Mended:
    """Applies edits to the rows of one conversation as they come."""

    def __init__(self, conv):
        self.conv, self.facts, self.edits = conv, None, []
        self.pending, self.place, self.state = "", 0, BEGIN

    def lead(self, edits: str, facts: tuple) -> None:
        self.edits.append(edits)
        self.pending = self.pending[self.place:] + edits
        self.place = 0
        if facts[0] is not None:
            self.facts = facts

    def _added(self) -> Iterator[tuple[str, str]]:
        while self.place < len(self.pending) and self.pending[self.place] == "I":
            self.place += 1
            yield self._other(), ""

    def _other(self) -> str:
        initial = "a" if self.state == USER else "u"
        self.state = NEXT[initial, self.state]
        return ROLES[initial]

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The repaired rows up to and with this one."""
        yield from self._added()
        edit = self.pending[self.place]
        self.place += 1
        if edit == "K":
            self.state = NEXT[role[:1], self.state]
            yield role, text
        elif edit == "R":
            yield self._other(), text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._added()


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Mended, Iterator[tuple[str, str]], bool]]:
    """Each row's conversation and repaired rows, and whether the conversation ends with them."""
    now = None
    for batch in batches:
        for conv, _, kind, edits, *facts, role, text in zip(*(batch.column(c).to_pylist() for c in STREAM)):
            if now is None or conv != now.conv:
                if now is not None:
                    yield now, now.end(), True
                now = Mended(conv)
            if kind == 0:
                now.lead(edits, tuple(facts))
            elif kind == 1:
                yield now, now.row(role, text), False
    if now is not None:
        yield now, now.end(), True


REPORT = "conv {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, " \
    "repaired_sha256 string"


def repair(conversations: DataFrame, costs: Costs = Costs(), every: DataFrame | None = None, page: int = PAGE,
           id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: id, gaps (turns missing between the first and the last), blank, duplicate, truncated (rows by
    their first fault), illegal (neighbours that don't follow each other), cost and audit (the edits' initials) of the
    best repair, repaired_sha256 (of its rows ``role:text``, joined by line feeds).

    Rows stand in the order of their turns, null ones first, and of equal turns in that of role and text. Null roles and
    texts are one blank. A row without an id is of the conversation without an id. With ``every``, each id of that table
    gets a row, with zeros, no edits and the digest of an empty string where it has no rows. An empty table gives none;
    other columns are not read. A conversation's edits are one string, so as long as it has rows.
    """
    stream = _stream(conversations, costs, page, every, id_col, turn_col, role_col, text_col)
    conv = stream.schema["conv"].dataType.simpleString()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, first, kind = [], hashlib.sha256(), True, None

        def batch() -> pa.RecordBatch:
            names = ["conv", *COUNTED, "cost", "audit", "repaired_sha256"]
            types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for one in source:
                kind = one.schema.field("conv").type
                yield one

        for now, rows, last in _mended(typed(batches)):
            for role, text in rows:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            if last:
                cost, *counted = now.facts or (0,) * 6
                out.append((now.conv, *counted, cost, "".join(now.edits), digest.hexdigest()))
                digest, first = hashlib.sha256(), True
                if len(out) >= 4096:
                    yield batch()
                    out = []
        if out:
            yield batch()

    return stream.mapInArrow(mapped, REPORT.format(conv)).withColumnRenamed("conv", id_col)


def repaired(conversations: DataFrame, costs: Costs = Costs(), page: int = PAGE, id_col: str = "conv_id",
             turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows of the best repairs: id, position (from 1), role, text. The cases of :func:`repair` hold; a conversation
    of which nothing is left has no rows."""
    stream = _stream(conversations, costs, page, None, id_col, turn_col, role_col, text_col)
    conv = stream.schema["conv"].dataType.simpleString()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, position, size, kind = [], 0, 0, None

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), [kind, pa.int64(), pa.string(), pa.string()])],
                                   names=["conv", "position", "role", "text"])

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for one in source:
                kind = one.schema.field("conv").type
                yield one

        for now, rows, last in _mended(typed(batches)):
            for role, text in rows:
                position += 1
                size += len(text)
                out.append((now.conv, position, role, text))
            if last:
                position = 0
            if out and (len(out) >= 4096 or size > 4 << 20):
                yield batch()
                out, size = [], 0
        if out:
            yield batch()

    return stream.mapInArrow(mapped, f"conv {conv}, position long, role string, text string").withColumnsRenamed(
        {"conv": id_col, "role": role_col, "text": text_col})

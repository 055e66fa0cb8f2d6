"""Repair of conversations by an error-correcting Earley parse of their roles.

The grammar gives an optional system turn and then pairs of user and assistant, or nothing at all.  Its
error productions delete a row, give it another role, or insert an empty turn, each at a price; a chart item
keeps the least (cost, audit), the audit being the initials of the edits so far: Keep, Rerole, Delete, Insert.
Rules are left-linear, so every item begins at the first row, a set of the chart holds an item or so a
rule, and only the last set is kept.  Two audits of one item and cost cover the same rows and thus as many
inserts, so neither begins the other and what is least stays least whatever follows.

Rows are dealt by conversation and sorted within it by Spark, then parsed as they stream by.  Edits on which
all items of a set agree are final: their rows leave memory, so a conversation of any length is repaired
in a few rows' space as long as the parse isn't ambiguous all along (rows of foreign roles only), where its rows wait.
Only the audit, one letter an edit, and the digest are carried to its end.  As a digest runs over the texts in
order, one conversation is one task's work.

Rows come by turn, nulls first, ties by role and then text; null roles and texts count as one space.  A null
id is a conversation like others; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
import os.path
from collections import deque
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from attestor.llm.common import map_arrow

#: Prices of the edits, and of a row that stays although it is cut off.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: Rules of the grammar.  Symbols of one letter are initials of roles; END stands behind the last row.
END = "end"
RULES = (
    ("Whole", ("Conversation", END)),
    ("Conversation", ()),
    ("Conversation", ("Answered",)),
    ("Opened", ("s",)),
    ("Asked", ("u",)),
    ("Asked", ("Opened", "u")),
    ("Asked", ("Answered", "u")),
    ("Answered", ("Asked", "a")),
)
#: Roles that an edit can give.
NAMES = {"u": "user", "a": "assistant"}
#: Faults of a row, the first that applies.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: By so much an item may cost more than the cheapest and still win.  The cheapest gets to any other's place by
#: two inserts, or by an insert to where a user is due and the deletion of the system turn that the other keeps.
SLACK = max(2 * INSERT, INSERT + DELETE)
#: Length of an item's open audit from which final edits are looked for.
OPEN = 32

_ITEMS = [(r, dot) for r, (_, body) in enumerate(RULES) for dot in range(len(body) + 1)]
_AFTER = {item: RULES[item[0]][1][item[1]] if item[1] < len(RULES[item[0]][1]) else None for item in _ITEMS}
_WAITING: dict[str, list[tuple[int, int]]] = {}
for _item in _ITEMS:
    if _item[1] == 0 and _AFTER[_item] is not None:
        _WAITING.setdefault(_AFTER[_item], []).append((_item[0], 1))
_FINAL = (0, 1)

Weight = tuple[int, str]


class Chart:
    """The last set of an Earley chart: items (rule, dot) with their least (cost, open audit)."""

    def __init__(self):
        self.items: dict[tuple[int, int], Weight] = {}
        for item in _ITEMS:
            if item[1] == 0:
                self._relax(self.items, item, (0, ""))
        self._complete()

    @staticmethod
    def _relax(items: dict[tuple[int, int], Weight], item: tuple[int, int], weight: Weight) -> bool:
        known = items.get(item)
        if known is None or weight < known:
            items[item] = weight
            return True
        return False

    def _complete(self) -> None:
        """Completions, and turns inserted without a row."""
        agenda = list(self.items)
        while agenda:
            rule, dot = item = agenda.pop()
            cost, audit = self.items[item]
            after = _AFTER[item]
            if after is None:
                for waiting in _WAITING.get(RULES[rule][0], ()):
                    if self._relax(self.items, waiting, (cost, audit)):
                        agenda.append(waiting)
            elif after in NAMES and self._relax(self.items, (rule, dot + 1), (cost + INSERT, audit + "I")):
                agenda.append((rule, dot + 1))

    def scan(self, initial: str, fault: int) -> None:
        """The next row: kept or given another role if it may stay, or deleted."""
        out: dict[tuple[int, int], Weight] = {}
        stays, more = fault not in (BLANK, DUPLICATE), CUT_OFF if fault == TRUNCATED else 0
        for item, (cost, audit) in self.items.items():
            after, then = _AFTER[item], (item[0], item[1] + 1)
            if after is None or not (len(after) == 1 or after == END):
                continue
            self._relax(out, item, (cost + DELETE, audit + "D"))
            if stays and after == initial:
                self._relax(out, then, (cost + more, audit + "K"))
            if stays and after in NAMES:
                self._relax(out, then, (cost + more + REROLE, audit + "R"))
        self.items = out
        self._complete()
        most = min(out.values())[0] + SLACK
        self.items = {item: weight for item, weight in out.items() if weight[0] <= most}

    def settled(self) -> str:
        """Edits on which all items agree; they leave the chart."""
        audits = [audit for _, audit in self.items.values()]
        if max(map(len, audits)) < OPEN:
            return ""
        common = os.path.commonprefix(audits)
        if common:
            self.items = {item: (cost, audit[len(common) :]) for item, (cost, audit) in self.items.items()}
        return common

    def result(self) -> Weight:
        """Cost of the repair and its open edits."""
        return self.items[_FINAL]


class Repair:
    """One conversation as its rows come by."""

    def __init__(self, conv: object, out: list[tuple] | None = None):
        self.conv, self.chart, self.waiting, self.out = conv, Chart(), deque(), out
        self.edits: list[str] = []
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = self.position = 0
        self.first = self.last = self.before = self.role = None
        self.digest = hashlib.sha256()

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        self.faults[fault] += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.waiting.append((role, text))
        self.chart.scan(initial, fault)
        self._apply(self.chart.settled())

    def _apply(self, edits: str) -> None:
        if edits:
            self.edits.append(edits)
        for edit in edits:
            role, text = ("", "") if edit == "I" else self.waiting.popleft()
            if edit == "D":
                continue
            if edit != "K":
                role = NAMES["a" if self.role == "u" else "u"]
            self.role = role[:1]
            self.digest.update((f"\n{role}:{text}" if self.position else f"{role}:{text}").encode())
            self.position += 1
            if self.out is not None:
                self.out.append((self.conv, self.position, edit, role, text))

    def finish(self) -> tuple:
        cost, edits = self.chart.result()
        self._apply(edits)
        gaps = min(self.last - self.first + 1 - self.turns, (1 << 63) - 1) if self.turns else 0
        return (self.conv, gaps, *self.faults[1:], self.illegal, cost, "".join(self.edits), self.digest.hexdigest())


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: Column | None) -> DataFrame:
    """Rows of each conversation together, in order, with their first fault.

    One shuffle, by conversation: the window over equal rows and the last sort find it in place.
    """
    plain = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"), (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    ).repartition("conv")
    earlier = F.row_number().over(W.partitionBy("conv", "role", "text", "present").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("nth") > 1, DUPLICATE).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(NONE)
    return plain.withColumn("nth", earlier).withColumn("fault", fault).sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "nth").select("conv", "turn", "role", "text", "present", "fault")


def _parsed(batches: Iterator[pa.RecordBatch], out: list[tuple] | None = None) -> Iterator[tuple | None]:
    """The summary of every conversation once it is over, and None after every batch."""
    now: Repair | None = None
    for batch in batches:
        for conv, turn, role, text, present, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    yield now.finish()
                now = Repair(conv, out)
            if present:
                now.add(turn, role, text, fault)
        yield None
    if now is not None:
        yield now.finish()


_SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _mapped(rows: DataFrame, schema: str, conv: str, turns: bool) -> DataFrame:
    """The repaired turns, or else the summaries, of prepared rows."""
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, {schema}"
    fields = StructType.fromDDL(schema).fields
    kinds, names = [to_arrow_type(f.dataType) for f in fields], [f.name for f in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        for done in chain(_parsed(batches, made if turns else None), [None]):
            if done is not None and not turns:
                made.append(done)
            if done is None and made:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names)
                made.clear()

    return map_arrow(rows, work, schema).withColumnRenamed("conv", conv)


def audit(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None) -> DataFrame:
    """One row a conversation: gaps in its turns, faults, illegal neighbours, and the cheapest repair.

    Rows where ``present`` isn't true only make sure that their conversation is reported.
    """
    return _mapped(_prepared(rows, conv, turn, role, text, present), _SUMMARY, conv, False)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None) -> DataFrame:
    """The repaired turns: conversation, position from 1, the edit that made it (K, R or I), role and text."""
    return _mapped(_prepared(rows, conv, turn, role, text, present), "position bigint, edit string, role string, text string", conv, True)

"""Repair of conversation structure: the cheapest edits that make the roles alternate.

A repaired conversation is empty, or an optional system turn and then turns of user and assistant in
turn, ending with the assistant. Rows are kept (K, cost 0), given the other role (R, 1), deleted (D, 2;
the only edit for a blank or repeated row) or an empty turn is inserted (I, 5); a truncated row that
stays costs 5 more. Of the cheapest edits, those whose letters come first in ASCII are taken.

The rows are repartitioned by conversation and sorted by turn, and one pass streams through each
partition. It carries the cheapest cost of each of the four places that an alternation can be in (nothing
yet, after system, user, assistant) over Arrow batches, however many a conversation has, and writes for
each row one byte a place: the edit and where it came from. These bytes and the row's text go to a spool,
which lies in memory up to ``SPOOL_BYTES`` and beyond it in an unnamed file of the running task, as
Spark's own spills do; a task that is run again starts with a new one. At a conversation's end the bytes
are read backwards for the edits and the texts forwards for the repaired turns. A conversation with a
third of all rows is thus sorted and read by one task, which holds a batch, a spool and one letter a row.

Costs more than ``SLACK`` above the cheapest place are dropped: two insertions lead from any place to one
from where the same edits can follow. What is left are few cost vectors, so a step is a lookup.

Whether a row repeats an earlier one of its conversation comes from a window over the same partitioning.
Null roles and texts count as one blank. A null conversation id is a conversation of its own; null turns
come first; rows of one turn are ordered by role and text. Equal rows are repeats of each other. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches

# Blank characters, and the ends of a whole sentence.
BLANKS, ENDS = " \t\n\x0b\f\r", ".!?"
# What edits cost.
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5
LEGAL = ("su", "ua", "au")
# Places of an alternation and where a role's initial leads from them.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
ROLE = {NOTHING: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}  # that may follow
MOST_INSERTED = 2
EDITS = tuple("I" * k + e for k in range(MOST_INSERTED + 1) for e in "DKR")
DEAD = 255
SLACK = MOST_INSERTED * COST["I"]
SPOOL_BYTES = 8 << 20
CHUNK_ROWS = 1 << 16

REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _follow(place: int) -> int:
    """The place after an inserted or rewritten turn."""
    return AFTER[place, ROLE[place][0]]


def _edits(place: int, initial: str, must_go: bool, cut: bool):
    """(edit, place after it, cost) for a row: insertions before it, then its own edit."""
    for k in range(MOST_INSERTED + 1):
        ins, cost, stay = "I" * k, k * COST["I"], TRUNCATED_COST if cut else 0
        yield ins + "D", place, cost + COST["D"]
        if not must_go:
            if (place, initial) in AFTER:
                yield ins + "K", AFTER[place, initial], cost + COST["K"] + stay
            yield ins + "R", _follow(place), cost + COST["R"] + stay
        place = _follow(place)


@lru_cache(maxsize=1 << 16)
def _step(costs: tuple, initial: str, must_go: bool, cut: bool):
    """Costs of the places after a row, from those before it.

    ``costs`` holds for each place (cost above the cheapest, rank of its letters among the places') or
    None. Letters of two places never begin alike to the end of one, since both end with the edit of the
    same row, so ranks and the new letters decide every tie. Returns the new costs, what they are above,
    and the row's bytes: edit and place before, for each place.
    """
    best = {}
    for place, known in enumerate(costs):
        if known:
            for edit, to, cost in _edits(place, initial, must_go, cut):
                found = (known[0] + cost, known[1], edit, place)
                best[to] = min(best.get(to, found), found)
    low = min(best.values())[0]
    live = sorted((to for to in best if best[to][0] <= low + SLACK), key=lambda to: best[to][1:3])
    back = [DEAD] * len(costs)
    new = [None] * len(costs)
    for rank, to in enumerate(live):
        cost, _, edit, place = best[to]
        new[to], back[to] = (cost - low, rank), EDITS.index(edit) << 2 | place
    return tuple(new), low, bytes(back)


class Conversation:
    """One conversation on its way through the stream."""

    def __init__(self, key):
        self.key, self.rows, self.cost = key, 0, 0
        self.costs = ((0, 0), None, None, None)
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.initial = None
        self.backs, self.texts = (SpooledTemporaryFile(SPOOL_BYTES) for _ in range(2))

    def add(self, has_turn: bool, turn: int, role: str, text: str, fault: str) -> None:
        if has_turn and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        self.illegal += self.rows > 0 and self.initial + initial not in LEGAL
        self.initial, self.rows = initial, self.rows + 1
        self.costs, low, back = _step(self.costs, initial if initial in ("s", "u", "a") else "",
                                      fault in ("blank", "duplicate"), fault == "truncated")
        self.cost += low
        self.backs.write(back)
        for part in (role, text):
            part = part.encode()
            self.texts.write(struct.pack("<Q", len(part)))
            self.texts.write(part)

    def _end(self):
        """(cost, place, insertions) that end the cheapest edits."""
        found = []
        for place, known in enumerate(self.costs):
            at, k = place, 0
            while known and at not in (NOTHING, ASSISTANT):
                at, k = _follow(at), k + 1
            if known:
                found.append((known[0] + k * COST["I"], known[1], place, k))
        cost, _, place, k = min(found)
        return self.cost + cost, place, k

    def edits(self, place: int) -> bytearray:
        """Index of each row's edit, from the spooled bytes read backwards."""
        out = bytearray(self.rows)
        for end in range(self.rows, 0, -CHUNK_ROWS):
            start = max(0, end - CHUNK_ROWS)
            self.backs.seek(4 * start)
            chunk = self.backs.read(4 * (end - start))
            for i in range(end - start - 1, -1, -1):
                back = chunk[4 * i + place]
                out[start + i], place = back >> 2, back & 3
        return out

    def repaired(self, edits: bytearray, inserted: int) -> Iterator[tuple]:
        """(edit, role, text) of the repaired turns, in order."""
        def read():
            (n,) = struct.unpack("<Q", self.texts.read(8))
            return self.texts.read(n).decode()

        self.texts.seek(0)
        place = NOTHING
        for index in edits:
            role, text = read(), read()
            for edit in EDITS[index]:
                if edit == "K":
                    yield "K", role, text
                    place = AFTER[place, role[0]]
                elif edit != "D":
                    yield edit, ROLE[place], text if edit == "R" else ""
                    place = _follow(place)
        for _ in range(inserted):
            yield "I", ROLE[place], ""
            place = _follow(place)

    def finish(self) -> tuple[tuple, Iterator[tuple]]:
        """The report, all but its digest, and the repaired turns."""
        cost, place, inserted = self._end()
        edits = self.edits(place)
        audit = "".join(EDITS[i] for i in edits) + "I" * inserted
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        report = (self.key, min(gaps, (1 << 63) - 1), *self.faults.values(), self.illegal, cost, audit)
        return report, self.repaired(edits, inserted)

    def close(self):
        self.backs.close()
        self.texts.close()


COLUMNS = ("key", "gone", "has_turn", "turn", "role", "text", "fault")


def _finished(batches: Iterator[pd.DataFrame]) -> Iterator[Conversation | None]:
    """Each conversation once all its rows are read, and None at each batch's end."""
    now = None
    for batch in batches:
        for key, gone, *row in zip(*(batch[c].tolist() for c in COLUMNS)):
            if now is None or key != now.key:
                if now:
                    yield now
                now = Conversation(key)
            if not gone:
                now.add(*row)
        yield None
    if now:
        yield now
    yield None


REPORT_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), *[T.StructField(c, T.LongType()) for c in REPORT],
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
TURNS_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("at", T.LongType()),
    T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType())])
OUT_ROWS = 4096


def _reports(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for done in _finished(batches):
        if done:
            report, turns = done.finish()
            digest = hashlib.sha256()
            for i, (_, role, text) in enumerate(turns):
                digest.update(f"{chr(10) if i else ''}{role}:{text}".encode())
            out.append((*report, digest.hexdigest()))
            done.close()
        elif out:
            yield pd.DataFrame(out, columns=REPORT_SCHEMA.names)
            out = []


def _turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for done in _finished(batches):
        if done:
            for at, turn in enumerate(done.finish()[1]):
                out.append((done.key, at, *turn))
                if len(out) == OUT_ROWS:
                    yield pd.DataFrame(out, columns=TURNS_SCHEMA.names)
                    out = []
            done.close()
        elif out:
            yield pd.DataFrame(out, columns=TURNS_SCHEMA.names)
            out = []


def _streamed(turns: DataFrame, conv: str, turn: str, role: str, text: str, gone: Column | None) -> DataFrame:
    """The rows of each conversation together and in order, each with its first fault."""
    bounded_batches(turns.sparkSession)
    blank = F.lit(" ")
    rows = turns.select(
        F.col(conv).cast("string").alias("key"), (F.lit(False) if gone is None else gone).alias("gone"),
        F.col(turn).isNotNull().alias("has_turn"), F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(role, blank).alias("role"), F.coalesce(text, blank).alias("text"))
    rows = rows.withColumn("_mark", F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text")))
    order = ["has_turn", "turn"]
    nth = F.row_number().over(Window.partitionBy("key", "gone", "_mark").orderBy(*order))
    rows = rows.repartition("key").withColumn("_nth", nth)
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = (F.when(F.col("gone"), "").when(end == "", "blank").when(F.col("_nth") > 1, "duplicate")
             .when(~end.isin(*ENDS), "truncated").otherwise(""))
    return (rows.withColumn("fault", fault)
            .sortWithinPartitions("key", *order, "role", "text", "_nth").select(*COLUMNS))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", gone: Column | None = None) -> DataFrame:
    """One row per conversation: ``conv``; ``gaps`` in its turns; rows that are ``blank``, ``duplicate``
    (role and text seen earlier) or ``truncated``, by their first fault; ``illegal`` neighbours; the
    ``cost`` of the cheapest edits, their letters as ``audit``, and the sha256 of the repaired turns as
    ``role:text`` lines. Rows for which ``gone`` holds only tell that their conversation exists."""
    out = _streamed(turns, conv, turn, role, text, gone).mapInPandas(_reports, REPORT_SCHEMA)
    kind = turns.schema[conv].dataType
    return out.select(F.col("key").cast(kind).alias(conv), *REPORT, "audit", "repaired_sha256")


def repaired(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text", gone: Column | None = None) -> DataFrame:
    """The repaired conversations as rows: ``conv``, ``at`` (from 0), ``edit``, ``role`` and ``text``."""
    out = _streamed(turns, conv, turn, role, text, gone).mapInPandas(_turns, TURNS_SCHEMA)
    kind = turns.schema[conv].dataType
    return out.select(F.col("key").cast(kind).alias(conv), "at", "edit", "role", "text")


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``turns`` with reproducible damage, for measuring a repair: crc32 of ``conv:turn`` modulo 20 says
    whether a row is dropped (0, kept here with ``gone``), emptied (1), loses its sentence ends (2), is
    repeated (3) or becomes the user's (4). Nulls are one blank first."""
    blank = F.lit(" ")
    at = F.concat(F.coalesce(F.col(conv).cast("string"), blank), F.lit(":"),
                  F.coalesce(F.col(turn).cast("string"), blank))
    rows = turns.select(F.col(conv), F.col(turn), F.coalesce(role, blank).alias(role),
                        F.coalesce(text, blank).alias(text), (F.crc32(at.cast("binary")) % 20).alias("_d"))
    d = F.col("_d")
    spoilt = rows.select(
        conv, turn, F.when(d == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(d == 1, "").when(d == 2, F.translate(text, ENDS, "")).otherwise(F.col(text)).alias(text),
        (d == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(d == 3, 2).otherwise(1))).alias("_copy"))
    return spoilt.drop("_copy")

"""Secrets in texts: three base patterns, and literals that reach a sensitive name by assignment.

One pass over the texts lexes them. ``statements`` reads what assigns in source code and configuration
(``name = "literal"``, ``name: literal``, ``"name": "literal"``, ``name := a + "b"``, ``cfg["name"] = x``,
``<name>literal</name>``, ``--name literal``, ``scheme://user:literal@host``) as a name with its terms, each
a literal or another name. A name used as a term stands for its last assignment before, so constants are
propagated along the statements of a text: read backwards, a statement hands its target's sensitivity,
less a tenth a step, to the statements that its terms stand for. What leaves the pass are spans, not
texts: the base entities, and each literal with the sensitivity it was handed, which Spark then weighs
by the literal itself (length, kinds and variety of characters, placeholders) and puts together per row.

Base entities stay as they are; a literal that overlaps one is not added. Added spans are of kind
``assign``. Places are code points, end exclusive. A null or empty text has no span, null ids and repeated
rows are rows of their own, an empty table gives an empty result, other columns are not read. A name has
at most ``NAME_CHARS`` characters, blanks before its operator included; texts are lexed whole, in time
proportional to their length.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, stored

KINDS = ("assign", "access", "hex")
# The base patterns; at least so many characters of the group count.
BASE = {
    "assign": (re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                          r"([A-Za-z0-9+/_.=-]+)", re.I | re.A), 1, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # a shorter run is no match: same entities, and no match for each a to f of a text
    "hex": (re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}"), 0, 24),
}

NAME_CHARS = 160
NAME = r"[A-Za-z_][A-Za-z0-9_]*(?:[.-][A-Za-z_][A-Za-z0-9_]*)*"
OPERATOR = re.compile(r":=|=>|(?<![=!<>:+*/-])=(?![=~>])|:(?![:/=])")
TARGET = re.compile(rf"(?<![A-Za-z0-9_.])({NAME})[\"']?\]?[ \t]*"
                    r"(?::[ \t]*[A-Za-z_][A-Za-z0-9_.\[\]|]*[ \t]*)?\Z")
QUOTED = re.compile(r"[rRbBuUfF]{0,2}(?:\"((?:[^\"\\\n]|\\.)*+)\"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`)")
WORD = re.compile(rf"\$?\{{?({NAME})\}}?(?![A-Za-z0-9_.(\[+/=-])")
BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>]++")
TYPED = re.compile(r"[ \t]*=(?!=)")  # what stood after the colon was a type
PLUS = re.compile(r"[ \t]*\+[ \t]*")
ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.-]{0,80})>([^<>\n]++)</\1>")
FLAG = re.compile(r"(?<![^\s\"'`(\[])--([A-Za-z][A-Za-z0-9_-]{0,80})[ \t]+(?!-)")
ADDRESS = re.compile(r"://[^\s:/@\"']{0,80}:([^\s:/@\"'<>]+)@")

# Words of names that hold secrets, words that make a key one, and last words of names
# that only tell about one.
SECRET_WORDS = ("password", "passwd", "pwd", "passphrase", "passcode", "secret", "token", "apikey",
                "credential", "credentials", "privatekey", "accesskey", "secretkey", "authkey")
KEY_WORDS = ("api", "access", "private", "secret", "signing", "encryption", "auth", "master", "account",
             "storage", "ssh", "client", "service")
HARMLESS_WORDS = ("name", "url", "uri", "path", "file", "dir", "id", "type", "kind", "count", "length", "len",
                  "size", "ttl", "expiry", "expires", "field", "label", "hint", "prompt", "policy", "limit",
                  "max", "min", "format", "header", "endpoint", "error", "message", "regex", "pattern",
                  "version", "enabled", "required")
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
STEP = 0.9
MIN_SCORE = 0.5
MIN_LENGTH = 6
# Literals that stand for no secret.
PLACEHOLDER = (r"(?i)^(x+|\*+|\.+|-+|changeme|change.me|example.*|none|null|nil|true|false|undefined|todo|test"
               r"|dummy|sample|placeholder|redacted|secret|password|your.*|my.*|<.*|\$.*|\{\{.*|%.*%|env:.*)$")


def sensitivity(name: str) -> float:
    """How sure a value of this name is a secret, from its words."""
    words = [w.lower() for w in WORDS.findall(name)]
    if not words or words[-1] in HARMLESS_WORDS:
        return 0.0
    secret = [w.endswith(SECRET_WORDS) for w in words]
    if secret[-1] or words[-1] == "key" and any(w in KEY_WORDS for w in words[:-1]):
        return 1.0
    return 0.7 if any(secret) else 0.0


def _value(text: str, at: int, names: bool) -> tuple[list[tuple], int]:
    """(start, end, name or None) of the terms of a value at ``at``, joined by plus signs, and the place
    from which operators may follow: what is inside a bare term is none."""
    terms, past = [], at
    while True:
        if found := QUOTED.match(text, at):
            terms.append((*found.span(found.lastindex), None))
        elif names and (found := WORD.match(text, at)):
            terms.append((*found.span(), found[1]))
        elif found := BARE.match(text, at):
            past = found.end()
            if text[past:past + 1] not in ("(", "["):  # else a call
                terms.append((*found.span(), None))
        if not found or not (plus := PLUS.match(text, found.end())):
            return terms, past
        at = plus.end()


def statements(text: str) -> list[tuple[int, str, list[tuple]]]:
    """(place, name, terms) of what a text assigns, in order."""
    out, past = [], 0
    for op in OPERATOR.finditer(text):
        target = op.start() >= past and TARGET.search(text, max(0, op.start() - NAME_CHARS), op.start())
        if target:
            at = op.end()
            while text[at:at + 1] in (" ", "\t"):
                at += 1
            # what follows a colon is data, and a bare word after it prose if its name tells nothing
            names = op[0] != ":"
            if names or text[at:at + 1] in ("'", '"') or sensitivity(target[1]):
                terms, end = _value(text, at, names)
                if names or not (terms and TYPED.match(text, terms[-1][1])):
                    out.append((op.start(), target[1], terms))
                    past = end
    if "</" in text:
        out += [(m.start(2), m[1], [(*m.span(2), None)]) for m in ELEMENT.finditer(text)]
    if "--" in text:
        out += [(m.end(), m[1], _value(text, m.end(), False)[0]) for m in FLAG.finditer(text)
                if sensitivity(m[1])]
    if "://" in text:
        out += [(m.start(1), "password", [(*m.span(1), None)]) for m in ADDRESS.finditer(text)]
    return sorted(out, key=lambda x: x[:2])


def literals(text: str) -> dict[tuple[int, int], float]:
    """Sensitivity handed to each literal of a text, by its span; those with none are left out."""
    found = statements(text)
    last, uses = {}, []
    for i, (_, name, terms) in enumerate(found):
        uses.append([last.get(ref) for _, _, ref in terms])
        last[name] = i
    handed = [sensitivity(name) for _, name, _ in found]
    out = {}
    for i in range(len(found) - 1, -1, -1):
        for (s, e, ref), known in zip(found[i][2], uses[i]):
            if known is not None:
                handed[known] = max(handed[known], STEP * handed[i])
            # a word that no statement before has given a value is a literal only with a digit in it
            elif handed[i] and (ref is None or re.search("[0-9]", text[s:e])):
                out[s, e] = max(out.get((s, e), 0.0), handed[i])
    return out


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base entities, leftmost and non-overlapping per kind."""
    return sorted((*m.span(), kind) for kind, (pattern, group, least) in BASE.items()
                  for m in pattern.finditer(text) if len(m[group]) >= least)


FOUND = pa.schema([("kind", pa.string()), ("s", pa.int64()), ("e", pa.int64()), ("handed", pa.float64()),
                   ("value", pa.string())])
FOUND_DDL = "kind string, s long, e long, handed double, value string"


def _spans(text: str | None) -> list[tuple]:
    """(kind, start, end, handed, value): a row without a kind, the base entities, the literals beside them."""
    out = [(None,) * len(FOUND)]
    if text:
        base = entities(text)
        starts, ends = [s for s, _, _ in base], list(accumulate((e for _, e, _ in base), max))

        def clear(s, e):
            before = bisect_left(starts, e)
            return not before or ends[before - 1] <= s

        out += [(kind, s, e, None, None) for s, e, kind in base]
        out += [("assign", s, e, handed, text[s:e]) for (s, e), handed in literals(text).items() if clear(s, e)]
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, out = [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            found = _spans(text)
            out += found
            at += [i] * len(found)
        if out:
            own = [batch.column(c).take(pa.array(at)) for c in ("row", "id")]
            yield pa.RecordBatch.from_arrays(
                [*own, *(pa.array(c, t) for c, t in zip(zip(*out), FOUND.types))], ["row", "id", *FOUND.names])


def weight(value: Column) -> Column:
    """How much a literal looks like a secret, from 0 to 1."""
    several = sum(value.rlike(c).cast("int") for c in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9\\s]"))
    varied = F.least(F.lit(1.0), F.size(F.array_distinct(F.split(value, ""))) / 8.0)
    plain = F.when(several >= 2, varied).otherwise(0.6 * varied)
    return (F.when((F.length(value) < MIN_LENGTH) | value.rlike(PLACEHOLDER), 0.0)
            .when(value.rlike(r"\s"), 0.4 * plain).otherwise(plain))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         min_score: float = MIN_SCORE) -> DataFrame:
    """(row, id, kind, s, e, base) of every span, and one row with a null kind for each row of ``docs``;
    ``row`` tells the rows of ``docs`` apart, ``base`` the base entities from what was added."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"),
                       F.col(id_col).alias("id"))
    schema = T.StructType([*rows.select("row", "id").schema.fields, *T.StructType.fromDDL(FOUND_DDL).fields])
    spans = stored(rows.mapInArrow(_scan, schema), "secrets")
    score = F.col("handed") * weight(F.col("value"))
    return (spans.where(F.col("handed").isNull() | (score >= min_score))
            .select("row", "id", "kind", "s", "e", F.col("handed").isNull().alias("base")))


def spans_per_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(``id_col``, n_<kind> of the base spans, base, spans) for each row of ``docs``; the last two list
    ``kind:start:end`` by start, then kind as listed, joined by commas."""
    found = find(docs, id_col, text_col, **options)
    line = F.concat_ws(":", "kind", F.col("s").cast("string"), F.col("e").cast("string"))
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    item = F.struct(F.col("s"), place.alias("o"), F.col("e"), line.alias("line"))
    per = found.groupBy("row").agg(
        F.max("id").alias("id"),
        *[F.count(F.when((F.col("kind") == k) & F.col("base"), 1)).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull() & F.col("base"), item))).alias("base"),
        F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), item))).alias("spans"))

    def text(name):
        return F.array_join(F.transform(name, lambda x: x["line"]), ",").alias(name)

    return per.select(F.col("id").alias(id_col), *[f"n_{k}" for k in KINDS], text("base"), text("spans"))

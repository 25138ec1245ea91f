"""Line dedup that can be taken back: sharded cuckoo filters over exact reference counts.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased; its
128-bit digest stands for it. The state is two tables:

* *references*: one row per digest with the exact number of documents that hold it, in shards by
  digest. Inserted documents add to it, deleted documents subtract from it;
* *filters*: per shard a cuckoo filter of the digests found in at least ``min_docs`` documents. A
  digest that crosses the limit on an insertion is put in, one that falls below it on a deletion is
  taken out, which a cuckoo filter can do.

The lines of a batch of documents are looked up in the filters, one probe per distinct digest (a
line in a third of all documents is one row by then). What a filter lets through is confirmed in
the exact references, so no line is dropped for a false positive.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import bounded_batches, rows, unused, utf8

STRIP = b" \t\n\x0b\x0c\r"
MIN_DOCS = 10
MIN_CHARS = 1
KEYS_PER_SHARD = 1 << 17
SLOTS = 4


class CuckooFilter:
    """Cuckoo filter over 128-bit digests: buckets of four 16-bit fingerprints, two places each."""

    def __init__(self, capacity: int, cells: np.ndarray | None = None):
        self.buckets = 1 << max(1, int(np.ceil(np.log2(max(1, capacity) / SLOTS / 0.8 + 1))))
        self.cells = np.zeros((self.buckets, SLOTS), dtype="u2") if cells is None else cells
        self.buckets = len(self.cells)

    @staticmethod
    def halves(digests) -> tuple[np.ndarray, np.ndarray]:
        words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
        return words[:, 0], words[:, 1]

    def places(self, digests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.halves(digests)
        mark = (b & 0xFFFF).astype("u2")
        mark[mark == 0] = 1
        one = (a & np.uint64(self.buckets - 1)).astype("i8")
        return mark, one, self.other(one, mark)

    def other(self, place, mark):
        step = (np.asarray(mark).astype("u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
        return place ^ (step & np.uint64(self.buckets - 1)).astype("i8")

    def contains(self, digests) -> np.ndarray:
        mark, one, two = self.places(digests)
        return ((self.cells[one] == mark[:, None]).any(axis=1)
                | (self.cells[two] == mark[:, None]).any(axis=1))

    def insert(self, digests) -> bool:
        """False when the filter is too full; it is then to be built anew with more buckets."""
        rng = np.random.default_rng(0)
        for mark, one, two in zip(*self.places(digests)):
            place = int(one)
            for place in (int(one), int(two)):
                free = np.flatnonzero(self.cells[place] == 0)
                if len(free):
                    self.cells[place, free[0]] = mark
                    break
            else:
                for _ in range(500):
                    slot = int(rng.integers(SLOTS))
                    mark, self.cells[place, slot] = self.cells[place, slot], mark
                    place = int(self.other(np.int64(place), mark))
                    free = np.flatnonzero(self.cells[place] == 0)
                    if len(free):
                        self.cells[place, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, digests) -> None:
        """Take out digests that were put in before."""
        for mark, one, two in zip(*self.places(digests)):
            for place in (int(one), int(two)):
                at = np.flatnonzero(self.cells[place] == mark)
                if len(at):
                    self.cells[place, at[0]] = 0
                    break

    @classmethod
    def of(cls, digests, capacity: int | None = None) -> CuckooFilter:
        capacity = capacity or len(digests)
        while True:
            f = cls(capacity)
            if not len(digests) or f.insert(digests):
                return f
            capacity *= 2


def line_key(line: bytes) -> bytes:
    return line.strip(STRIP).lower()


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, key): the distinct digests of each document. Rows with the same id are one document, and
    so are all rows with a null id. A null text is one empty line; keys shorter than ``min_chars``
    code points have no row."""
    bounded_batches(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for b in rows(whole, 512):
                keys, lengths = [], []
                for text in utf8(b.column(1)):
                    own = {line_key(x) for x in text.split(b"\n")}
                    own = [digest(k) for k in own if _long_enough(k, min_chars)]
                    keys += own
                    lengths.append(len(own))
                ids = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), lengths)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary())],
                                                 names=["id", "key"])

    return (docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, key binary not null")
            .distinct())


def references(lines: DataFrame) -> DataFrame:
    """(key, refs): in how many documents each digest is. Combined before the shuffle."""
    return lines.groupBy("key").agg(F.count("*").alias("refs"))


def insert_documents(refs: DataFrame, lines: DataFrame) -> DataFrame:
    """References after new documents; ``lines`` are theirs from :func:`line_digests`."""
    return (refs.select("key", "refs").unionAll(references(lines)).groupBy("key")
            .agg(F.sum("refs").alias("refs")))


def delete_documents(refs: DataFrame, lines: DataFrame) -> DataFrame:
    """References after documents that were inserted before are gone; digests without any go too."""
    gone = references(lines).select("key", (-F.col("refs")).alias("refs"))
    return (refs.select("key", "refs").unionAll(gone).groupBy("key")
            .agg(F.sum("refs").alias("refs")).where("refs > 0"))


def shard_of(key, shards: int):
    return F.pmod(F.xxhash64(key), F.lit(shards))


def shard_count(refs: DataFrame) -> int:
    """Shards that hold about ``KEYS_PER_SHARD`` digests each, however many there are."""
    return 1 + refs.count() // KEYS_PER_SHARD


def line_count(docs: DataFrame, text_col: str = "text") -> int:
    """How many lines the texts have: at least as many as they have distinct digests."""
    text = F.col(text_col).cast("string")
    feeds = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return docs.agg(F.sum(F.coalesce(feeds, F.lit(0)).cast("bigint") + 1)).first()[0] or 0


def build_filters(refs: DataFrame, shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """(shard, buckets): one cuckoo filter per shard, of its digests with ``min_docs`` documents."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = CuckooFilter.of(list(pdf["key"]))
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "buckets": [f.cells.tobytes()]})

    often = refs.where(F.col("refs") >= min_docs).select(shard_of("key", shards).alias("shard"), "key")
    return often.groupBy("shard").applyInPandas(build, "shard bigint, buckets binary")


def _load(pdf: pd.DataFrame) -> CuckooFilter | None:
    if not len(pdf):
        return None
    cells = np.frombuffer(pdf["buckets"].iloc[0], dtype="u2").reshape(-1, SLOTS).copy()
    return CuckooFilter(0, cells)


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, shards: int,
                   min_docs: int = MIN_DOCS) -> DataFrame:
    """Filters after the references went from ``before`` to ``after``: only digests that crossed the
    limit are put in or taken out. A shard whose filter is full is built anew from ``after``."""
    old = before.where(F.col("refs") >= min_docs).select("key", F.lit(1).alias("old"))
    new = after.where(F.col("refs") >= min_docs).select("key", F.lit(1).alias("new"))
    change = (old.join(new, "key", "full")
              .select(shard_of("key", shards).alias("shard"), "key", "old", "new"))

    def step(key, pdf, state):
        f = _load(state)
        out = list(pdf.loc[pdf["new"].isna(), "key"])
        add = list(pdf.loc[pdf["old"].isna(), "key"])
        if f is None:
            f = CuckooFilter.of(add)
        else:
            if out:
                f.delete(out)
            if add and not f.insert(add):
                f = CuckooFilter.of(list(pdf.loc[pdf["new"].notna(), "key"]), 2 * f.buckets * SLOTS)
        return pd.DataFrame({"shard": [key[0]], "buckets": [f.cells.tobytes()]})

    return (change.groupBy("shard").cogroup(filters.groupBy("shard"))
            .applyInPandas(step, "shard bigint, buckets binary"))


def frequent_lines(keys: DataFrame, refs: DataFrame, filters: DataFrame, shards: int,
                   min_docs: int = MIN_DOCS) -> DataFrame:
    """(key): those of the distinct ``keys`` that are in ``min_docs`` documents. The shard's filter
    is asked first, the exact references confirm what it lets through."""
    def probe(pdf, state):
        f = _load(state)
        if f is None or not len(pdf):
            return pd.DataFrame({"key": pd.Series([], dtype=object)})
        return pdf.loc[f.contains(list(pdf["key"])), ["key"]]

    maybe = (keys.select(shard_of("key", shards).alias("shard"), "key").groupBy("shard")
             .cogroup(filters.groupBy("shard")).applyInPandas(probe, "key binary"))
    return maybe.join(refs.where(F.col("refs") >= min_docs), "key", "left_semi")


def counts(docs: DataFrame) -> list[str]:
    """Names of the two columns that :func:`drop_lines` adds: ``_llm_lines`` and ``_llm_dropped``, with
    underscores added where ``docs`` has such columns."""
    return unused(docs, "_llm_lines", "_llm_dropped")


def drop_lines(docs: DataFrame, lines: DataFrame, frequent: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` without the lines whose digest is in ``frequent``; the other lines joined by a line
    feed. All columns stay; two are added at the end, named by :func:`counts`: the numbers of lines
    before and of lines dropped. A null text becomes empty."""
    bounded_batches(docs.sparkSession)
    own_id, own_keys = unused(docs, "_llm_id", "_llm_keys")
    own = (lines.join(frequent, "key", "left_semi").groupBy(F.col("id").alias(own_id))
           .agg(F.collect_list("key").alias(own_keys)))
    joined = docs.join(own, F.col(id_col).eqNullSafe(F.col(own_id)), "left").drop(own_id)
    names = docs.columns
    at = names.index(text_col)
    schema = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in counts(docs)]])

    def run(batches):
        for whole in batches:
            for b in rows(whole, 512):
                texts, n_lines, n_dropped = [], [], []
                for text, keys in zip(utf8(b.column(at)), b.column(len(names)).to_pylist()):
                    parts = text.split(b"\n")
                    n_lines.append(len(parts))
                    if keys:
                        keys = set(keys)
                        parts = [x for x in parts if digest(line_key(x)) not in keys]
                    n_dropped.append(n_lines[-1] - len(parts))
                    texts.append(b"\n".join(parts))
                cols = [b.column(i) for i in range(len(names))]
                cols[at] = pa.array(texts, pa.binary()).cast(b.schema.types[at])
                yield pa.RecordBatch.from_arrays(
                    cols + [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                    names=[f"c{i}" for i in range(len(cols) + 2)])

    return joined.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Build the state for ``docs`` and drop their frequent lines; see :func:`drop_lines`.

    One plan without tables in between: digests and references are read again from their exchanges.
    Only the number of lines, for the number of shards, is asked before.
    """
    lines = line_digests(docs, id_col, text_col, min_chars)
    refs = references(lines)
    shards = 1 + line_count(docs, text_col) // KEYS_PER_SHARD
    filters = build_filters(refs, shards, min_docs)
    held = refs.where("refs > 0")  # all of them; with the counts, it reads the exchange of ``refs``
    return drop_lines(docs, lines, frequent_lines(held, refs, filters, shards, min_docs), id_col,
                      text_col)

"""Substring dedup with one compressed FM-index per shard.

A passage of ``window`` words is removed where the same words also start in a document with a
smaller id.

1. Every document gives anchors: the word runs of ``GRAM`` words whose hash is the smallest among the
   runs of some window. A window's anchor depends on its words alone, so documents that share a
   window share an anchor. The first and last document of each anchor are found by a combined
   aggregation; anchors of one document only are dropped.
2. Around its shared anchors each document is cut into pieces, keyed by the anchor's first document.
   All windows with an anchor are so found under one key, and most of them in that document.
3. The pieces of the first documents make the shards: an FM-index each, kept as a table. The other
   documents' pieces are streamed to the shards. Backward search over the wavelet matrix gives
   matching statistics, and where they reach ``window`` the smallest document of the interval.
   An anchor in very many documents sends them to several tasks with the same index.
4. Windows that the first document does not have may still be shared by later ones. They are kept as
   64-bit hashes with their places and settled by an exact smallest-id aggregation.

Words are the runs of ``[^\\x20\\x09-\\x0D]``, compared by 64 bits of their digest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, rows, stored, utf8
from .fm_index import FmIndex
from .words import grams, word_hashes

WINDOW = 50
GRAM = 16
SHARD_WORDS = 1 << 17
STREAM_WORDS = 1 << 20
HOT = 4096
CHUNK = 256


def _running(x: np.ndarray, w: int, pick, fill: int) -> np.ndarray:
    """``pick`` (minimum or maximum) of x[i:i + w] for each i, in a few passes."""
    n = len(x)
    padded = np.append(x, np.full(-n % w + w, fill, dtype="u8")).reshape(-1, w)
    ahead = pick.accumulate(padded, axis=1).ravel()
    back = pick.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], ahead[w - 1:w - 1 + n])


def anchors(hashes: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> tuple:
    """(places, hashes) of the anchors of several documents whose words follow each other."""
    n = len(hashes)
    runs = grams(hashes, gram)
    w = window - gram + 1
    if len(runs) < w:
        return np.zeros(0, dtype="i8"), runs[:0]
    runs = np.maximum(runs, np.uint64(1))
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)  # words up to the document's end
    least = _running(runs, w, np.minimum, 2 ** 64 - 1)
    least[left[:len(runs)] < window] = 0  # no window starts here
    most = _running(np.concatenate([np.zeros(w - 1, dtype="u8"), least]), w, np.maximum, 0)
    places = np.flatnonzero(most[:len(runs)] == runs)
    return places, runs[places]


def _anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, id, h, place, lead): lead is 1 at an anchor's first place in a document, else 0."""
    def run(batches):
        for whole in batches:
            for b in rows(whole, 256):
                own = [word_hashes(t) for t in utf8(b.column(2))]
                lengths = np.array([len(x) for x in own], dtype="i8")
                places, found = anchors(np.concatenate(own), lengths, window, gram)
                starts = np.cumsum(lengths) - lengths
                doc = np.searchsorted(starts + lengths, places, side="right")
                at = pa.array(doc)
                order = np.lexsort((places, found, doc))
                lead = np.ones(len(places), dtype="i4")
                lead[order[1:]] = ((found[order[1:]] != found[order[:-1]])
                                   | (doc[order[1:]] != doc[order[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view("i8")), b.column(0).take(at), b.column(1).take(at),
                     pa.array((places - starts[doc]).astype("i4")), pa.array(lead)],
                    names=["anchor", "id", "h", "place", "lead"])

    return docs.mapInArrow(run, "anchor bigint, id bigint, h bigint, place int, lead int")


def _pieces(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Pieces of documents around their shared anchors: (first, id, h, start, hot, words, text)."""
    def run(batches):
        for whole in batches:
            for b in rows(whole, 128):
                out = {k: [] for k in ("first", "id", "h", "start", "hot", "words", "text")}
                for doc, h, text, marks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                               utf8(b.column(2)), b.column(3)):
                    words = text.split()
                    last = len(words) - window
                    marks = marks.values
                    first = marks.field("first").to_numpy()
                    place = marks.field("place").to_numpy().astype("i8")
                    many = marks.field("n").to_numpy()
                    order = np.lexsort((place, first))
                    first, place, many = first[order], place[order], many[order]
                    lo = np.maximum(place - (window - gram), 0)
                    new = np.append(True, (first[1:] != first[:-1]) | (lo[1:] > place[:-1] + 1))
                    heads = np.flatnonzero(new)
                    ends = np.append(heads[1:], len(place)) - 1
                    hot = np.maximum.reduceat(many, heads)
                    for i, j, n in zip(heads, ends, hot):
                        start, stop = int(lo[i]), min(int(place[j]), last) + window
                        out["first"].append(int(first[i]))
                        out["id"].append(doc)
                        out["h"].append(h)
                        out["start"].append(start)
                        out["hot"].append(int(n))
                        out["words"].append(stop - start)
                        out["text"].append(b" ".join(words[start:stop]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[k], pa.int64()) for k in list(out)[:6]]
                    + [pa.array(out["text"], pa.binary())], names=list(out))

    return docs.mapInArrow(run, "first bigint, id bigint, h bigint, start bigint, hot bigint, "
                                "words bigint, text binary")


def build_indexes(pieces: DataFrame, shards: int, window: int = WINDOW) -> DataFrame:
    """(shard, data): an FM-index per shard over the pieces of the first documents."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = pdf.drop_duplicates(["id", "text"]).sort_values(["id", "text"])
        index = FmIndex.build([word_hashes(t) for t in texts["text"]], list(texts["id"]), window)
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "data": [index.dump()]})

    own = pieces.where("id = first").select(_shard(shards).alias("shard"), "id", "text")
    return own.groupBy("shard").applyInPandas(build, "shard bigint, data binary")


def _shard(shards: int):
    return F.pmod(F.xxhash64("first"), F.lit(shards))


def _chunks(hashes: np.ndarray, window: int) -> list:
    """Parts of at most ``CHUNK`` window starts, so that many are searched in step."""
    return [(at, hashes[at:at + CHUNK + window - 1])
            for at in range(0, max(1, len(hashes) - window + 1), CHUNK)]


def match_pieces(pieces: DataFrame, indexes: DataFrame, shards: int, salts: int,
                 window: int = WINDOW) -> DataFrame:
    """Search the pieces of all but the first documents in their shard. Rows (id, h, start, stop,
    run, open): words from start to stop are covered by windows of a smaller document, or, if open,
    the window at start, with its hash in run, is not yet settled."""
    def look(key, asked, held):
        out = {c: [] for c in ("id", "h", "start", "stop", "run", "open")}
        if not len(asked) or not len(held):
            return pd.DataFrame(out)
        index = FmIndex.load(held["data"].iloc[0])
        asked = asked.reset_index(drop=True)
        code, texts = pd.factorize(asked["text"])
        hashes = [word_hashes(t) for t in texts]
        low = [np.full(max(0, len(x) - window + 1), np.iinfo("i8").max) for x in hashes]
        parts = [(i, at, part) for i, x in enumerate(hashes) for at, part in _chunks(x, window)]
        whose = np.array([p[0] for p in parts])
        offset = np.array([p[1] for p in parts])

        def report(n, place, doc):
            flat[base[whose[n]] + offset[n] + place] = doc

        sizes = np.array([len(x) for x in low], dtype="i8")
        base = np.cumsum(sizes) - sizes
        flat = np.concatenate(low)
        index.search([p[2] for p in parts], report)
        runs = [grams(x, window).view("i8") for x in hashes]
        for c, doc, h, start in zip(code, asked["id"], asked["h"], asked["start"]):
            found = flat[base[c]:base[c] + sizes[c]] < doc
            edge = np.flatnonzero(np.diff(np.concatenate([[0], found.view("i1"), [0]])))
            lo, hi = edge[::2], edge[1::2]
            rest = np.flatnonzero(~found)
            rows_of = len(lo) + len(rest)
            out["id"].append(np.full(rows_of, doc))
            out["h"].append(np.full(rows_of, h))
            out["start"].append(start + np.concatenate([lo, rest]))
            out["stop"].append(start + np.concatenate([hi - 1, rest]) + window)
            out["run"].append(np.concatenate([np.zeros(len(lo), dtype="i8"), runs[c][rest]]))
            out["open"].append(np.arange(rows_of) >= len(lo))
        return pd.DataFrame({k: np.concatenate(v) for k, v in out.items()})

    spread = F.pmod(F.xxhash64("id", "h"), (F.lit(salts) + F.floor(F.col("hot") / HOT))).cast("int")
    asked = (pieces.where("id != first").select(_shard(shards).alias("shard"), spread.alias("salt"),
                                                "id", "h", "start", "text"))
    places = asked.select(F.col("shard").alias("to"), F.col("salt").alias("copy")).distinct()
    held = (indexes.join(places, F.col("shard") == F.col("to"))
            .select(F.col("to").alias("of"), "copy", "data"))
    return (asked.groupBy("shard", "salt").cogroup(held.groupBy("of", "copy"))
            .applyInPandas(look, "id bigint, h bigint, start bigint, stop bigint, run bigint, open boolean"))


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, h, spans): per document with repeats, the word intervals [start, stop) to remove; ``h`` is
    the xxhash64 of the text, so that rows with the same id are told apart."""
    bounded_batches(docs.sparkSession)
    texts = (docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"),
                     F.col(text_col).alias("text")))
    marked = stored(_anchor_rows(texts.select("id", "h", "text"), window, gram), "anchors")
    shared = (marked.groupBy("anchor").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                           F.sum("lead").alias("n")).where("first < last"))
    # a table of its own, so that the join below has a plain exchange on each side and a hot anchor's
    # rows can be split over tasks
    shared = stored(shared, "shared")
    by_doc = (marked.join(shared.select("anchor", "first", "n"), "anchor").groupBy("id", "h")
              .agg(F.collect_list(F.struct("first", "place", "n")).alias("marks")))
    # repeated rows (same id and text) would give the same pieces again
    with_text = by_doc.join(texts, ["id", "h"]).select("id", "h", "text", "marks")
    pieces = stored(_pieces(with_text, window, gram), "pieces")
    size = pieces.agg(F.sum(F.when(F.col("id") == F.col("first"), F.col("words"))).alias("own"),
                      F.sum("words").alias("all")).first()
    shards = 1 + (size["own"] or 0) // SHARD_WORDS
    salts = 1 + (size["all"] or 0) // (shards * STREAM_WORDS)
    indexes = stored(build_indexes(pieces, shards, window), "fm")
    matched = stored(match_pieces(pieces, indexes, shards, salts, window), "matched")
    open_ = matched.where("open")
    lowest = (open_.groupBy("run").agg(F.min("id").alias("low"), F.max("id").alias("high"))
              .where("low < high"))
    late = open_.join(lowest.select("run", "low"), "run").where("id > low")
    spans = (matched.where("NOT open").select("id", "h", "start", "stop")
             .unionAll(late.select("id", "h", "start", "stop")))
    return spans.groupBy("id", "h").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(``id_col``, ``text_col``, n_words, n_removed) for each row: the words that stay, joined by one
    space, the number of words and of removed words.

    A word goes when it is in a run of ``window`` words that also starts in a document with a smaller
    id (ids are integers); runs are judged on the input. Rows with the same id are one document: they
    do not remove from each other. Rows with a null id neither lose words nor make others lose any.
    A null text has no words. Texts with fewer words than ``window`` lose none. Other columns are not
    read.
    """
    spans = repeated_words(docs, id_col, text_col, window, gram).withColumnsRenamed(
        {"id": "_llm_id", "h": "_llm_h"})
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = own.join(spans, (F.col("id").cast("long") == F.col("_llm_id"))
                      & (F.xxhash64("text") == F.col("_llm_h")), "left").select("id", "text", "spans")
    kind = own.schema["id"].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for b in rows(whole, 256):
                texts, n, gone = [], [], []
                for text, marks in zip(utf8(b.column(1)), b.column(2)):
                    words = text.split()
                    n.append(len(words))
                    if marks.is_valid:
                        step = np.zeros(len(words) + 1, dtype="i8")
                        np.add.at(step, marks.values.field("start").to_numpy(), 1)
                        np.add.at(step, marks.values.field("stop").to_numpy(), -1)
                        stay = np.flatnonzero(np.cumsum(step)[:-1] == 0)
                        words = [words[i] for i in stay]
                    gone.append(n[-1] - len(words))
                    texts.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(texts, pa.binary()).cast(pa.string()),
                     pa.array(n, pa.int64()), pa.array(gone, pa.int64())],
                    names=["id", "text", "n_words", "n_removed"])

    return joined.mapInArrow(
        run, f"`{id_col}` {kind}, `{text_col}` string, n_words bigint, n_removed bigint")

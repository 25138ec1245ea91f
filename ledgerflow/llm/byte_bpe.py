"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are split at safe boundaries first, so that one call never holds a huge text. A place
before a space or line feed whose left neighbour is a letter, digit or punctuation sign is safe:
no alternative of the pattern matches a non-space followed by white space, and its one lookahead
(``\\s+(?!\\S)``) only looks from white space to the right, so the matches left of the place are
the same whether or not the rest is seen, and a new match starts there. Between an ASCII letter and
an ASCII digit the same holds, as no match has both. A run without such a place stays whole, as it
is one match. This holds for patterns that split as GPT-2's does: :func:`check_pattern` tries a pattern on
pairs of signs of every kind around the places and refuses one that has a match across any of them.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import bounded_batches, rows

SPLIT_CHARS = 1 << 16
SAFE = regex.compile(r"(?<=[\p{L}\p{N}\p{P}])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The library's encoding, built once per Python worker."""
    import tiktoken
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(k): int(v) for k, v in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local-ranks", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens={})


#: signs of every kind that a pattern may tell apart: letters, marks, digits, punctuation, symbols, blanks
KINDS = ("a", "Z", "é", "漢", "ʰ", "7", "٣", "Ⅷ", "½", ".", "'", "-", "(", "_", "!", "$", "+", "\u0301", "😀", "s", " ", "\n",
         "\r", "\t")


@functools.lru_cache(maxsize=4)
def check_pattern(pattern: str) -> None:
    """Raises ValueError if ``pattern`` has a match across a place that ``SAFE`` takes for a cut, tried on all
    texts of up to two signs left and two right of the place."""
    matcher = regex.compile(pattern)
    sides = ["", *KINDS]
    for before in sides:
        for left in KINDS:
            for right in KINDS:
                if not SAFE.search(left + right):
                    continue
                for after in sides:
                    text, cut = before + left + right + after, len(before) + 1
                    whole = [m.span() for m in matcher.finditer(text)]
                    parts = [m.span() for m in matcher.finditer(text[:cut])]
                    parts += [(a + cut, b + cut) for a, b in (m.span() for m in matcher.finditer(text[cut:]))]
                    if whole != parts:
                        raise ValueError(f"pattern cannot be cut in long texts: {text!r} is matched across {cut}")


def safe_parts(text: str, size: int = SPLIT_CHARS) -> Iterator[str]:
    """``text`` in parts of at least ``size`` characters (the last may be shorter), cut where no
    match of the pattern can span the cut."""
    at = 0
    while len(text) - at > size:
        cut = SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(enc, text: str, size: int = SPLIT_CHARS) -> np.ndarray:
    """Token ids (uint32) of a whole text."""
    if len(text) <= size:
        return np.array(enc.encode_ordinary(text), dtype="<u4")
    return np.concatenate([np.array(enc.encode_ordinary(p), dtype="<u4")
                           for p in safe_parts(text, size)])


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", split_chars: int = SPLIT_CHARS) -> DataFrame:
    """(``id_col``, ids array<long>) for each row of ``docs``, in one pass without a shuffle.

    A null or empty text gives an empty array; a null id and repeated rows stay as they are; other
    columns are not read. ``rank_file`` must be readable at that path on every executor. A ``pattern`` that
    cannot be cut at the safe places is refused, see :func:`check_pattern`.
    """
    check_pattern(pattern)
    bounded_batches(docs.sparkSession)

    def run(batches):
        enc = encoding(rank_file, pattern)
        for whole in batches:
            for b in rows(whole, 256):
                ids = [encode_text(enc, t or "", split_chars).astype("i8")
                       for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(ids, pa.list_(pa.int64()))], names=["id", "ids"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<bigint>")


def decode(tokens: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, data binary): the raw bytes of each row's ``ids``. A null array gives empty
    bytes; an id without a rank is an error, as in the library."""
    bounded_batches(tokens.sparkSession)

    def run(batches):
        enc = encoding(rank_file, pattern)
        for whole in batches:
            for b in rows(whole, 256):
                data = [enc.decode_bytes(x or []) for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())],
                                                 names=["id", "data"])

    kind = tokens.select(id_col).schema[0].dataType.simpleString()
    return tokens.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, data binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", split_chars: int = SPLIT_CHARS,
               with_ids: bool = False) -> DataFrame:
    """Encoding and decoding in one pass: (id, n_tokens, ids_sha256 of the ids as little-endian
    unsigned 32-bit integers, decoded_sha256 of the decoded bytes), and with ``with_ids`` the ids.
    Nulls, empty texts and repeated rows as in :func:`encode`."""
    check_pattern(pattern)
    bounded_batches(docs.sparkSession)

    def run(batches):
        enc = encoding(rank_file, pattern)
        for whole in batches:
            for b in rows(whole, 512):
                n, enc_sha, dec_sha, kept = [], [], [], []
                for t in b.column(1).to_pylist():
                    ids = encode_text(enc, t or "", split_chars)
                    n.append(len(ids))
                    if with_ids:
                        kept.append(ids.astype("i4"))
                    enc_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    dec_sha.append(hashlib.sha256(enc.decode_bytes(ids.tolist())).hexdigest())
                cols = [b.column(0), pa.array(n, pa.int64()), pa.array(enc_sha), pa.array(dec_sha)]
                if with_ids:
                    cols.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(cols))])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, text_col).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))

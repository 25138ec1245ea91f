"""Token counts of a sentencepiece BPE model, with overlap resynchronisation for huge documents.

A boundary between two characters is *proven stable* when no piece of the vocabulary has this pair
of neighbours: a merge always makes a piece, so no merge can ever cross the boundary, and what lies
left and right of it is encoded the same whether or not the other side is seen. (Line feeds and the
step from a word into a space are such places in the usual models; it is read from the vocabulary.)

Documents above ``chunk_chars`` are encoded as overlapping chunks with token offsets. Two chunks are
spliced at a boundary in their overlap at which both encodings have a token end and which is proven
stable; while there is none, the overlap is doubled, up to the whole rest of the text.

Shorter texts are one chunk. There the text is cut at proven stable white-space boundaries and the
library's count of each part is kept in a bounded memo, as most words repeat.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, rows

SPACE = "▁"
CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 256
MEMO_ENTRIES = 500_000


class Counter:
    """Counts for one model file; lives once per Python worker."""

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        spec = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            spec.ParseFromString(f.read())
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        norm = spec.normalizer_spec
        # chunks can be encoded apart when normalising is only the mark of spaces and a first mark
        self.plain = (norm.name == "identity" and not norm.precompiled_charsmap
                      and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
                      and norm.escape_whitespaces and spec.trainer_spec.byte_fallback
                      and spec.trainer_spec.model_type == 2
                      and not spec.trainer_spec.treat_whitespace_as_suffix
                      and not any(p.type == 4 for p in spec.pieces))
        norm.add_dummy_prefix = False
        self.part = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.width = np.array([len(p.piece) for p in spec.pieces])
        self.follows = np.zeros(len(spec.pieces), dtype=bool)  # a byte inside a character
        for i, p in enumerate(spec.pieces):
            if p.type == 6:
                self.follows[i] = int(p.piece[3:5], 16) & 0xC0 == 0x80
                self.width[i] = not self.follows[i]
        self.pairs = {p.piece[i:i + 2] for p in spec.pieces if p.type == 1
                      for i in range(len(p.piece) - 1)}
        into_space = any(q[1] == SPACE and q[0] != SPACE for q in self.pairs)
        line_feed = any("\n" in q for q in self.pairs)
        self.plain = self.plain and not into_space
        word = f"{SPACE}*[^{SPACE}]+|{SPACE}+" if line_feed else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+"
        self.words = re.compile(word)
        self.memo: dict[str, int] = {}

    def stable(self, text: str, at: int) -> bool:
        return at <= 0 or at >= len(text) or text[at - 1:at + 1] not in self.pairs

    def _part(self, word: str) -> int:
        n = self.memo.get(word)
        if n is None:
            n = len(self.part.encode(word))
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            if len(word) <= 64:
                self.memo[word] = n
        return n

    def ends(self, text: str, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ends of ``text[start:stop]`` encoded alone: places in ``text`` and tokens so far.
        A character spelled in bytes ends with the last of them."""
        ids = np.array(self.part.encode(text[start:stop]), dtype="i4")
        at = start + np.cumsum(self.width[ids])
        end = np.append(~self.follows[ids[1:]], True)[:len(ids)]
        n = np.arange(1, len(ids) + 1)
        return np.append(start, at[end]), np.append(0, n[end])

    def spliced(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of an already marked ``text`` by overlapping chunks."""
        total, done, stop = 0, 0, min(len(text), chunk)
        places, tokens = self.ends(text, 0, stop)
        while stop < len(text):
            width = overlap
            while True:
                start = max(done, stop - width)
                stop2 = min(len(text), max(stop, start) + chunk)
                places2, tokens2 = self.ends(text, start, stop2)
                # the right chunk starts anywhere, the left one ends anywhere: only boundaries that
                # both have and that no merge can cross are taken, the middle one of them
                common = np.intersect1d(places, places2, assume_unique=True)
                common = [int(at) for at in common if (start < at or start == done > 0) and at < stop
                          and self.stable(text, int(at))]
                if common:
                    break
                if start == 0:
                    return len(self.part.encode(text))
                width *= 2
            cut = common[len(common) // 2]
            total += int(tokens[np.searchsorted(places, cut)])
            keep = places2 >= cut
            places, tokens = places2[keep], tokens2[keep]
            tokens = tokens - tokens[0]
            done, stop = cut, stop2
        return total + int(tokens[-1])

    def count(self, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
        if not text:
            return 0
        if not self.plain:
            return len(self.whole.encode(text))
        marked = SPACE + text.replace(" ", SPACE)
        if len(marked) > chunk:
            return self.spliced(marked, chunk, overlap)
        return sum(map(self._part, self.words.findall(marked)))


@functools.lru_cache(maxsize=4)
def counter(model_file: str) -> Counter:
    return Counter(model_file)


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(``id_col``, n_bytes, n_tokens) for each row, in one pass without a shuffle.

    n_bytes counts UTF-8 bytes. A null or empty text has none of either; a null id and repeated rows
    stay as they are; other columns are not read.
    """
    bounded_batches(docs.sparkSession)

    def run(batches):
        c = counter(model_file)
        for whole in batches:
            for b in rows(whole, 512):
                texts = [t or "" for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                     pa.array([c.count(t, chunk_chars, overlap_chars) for t in texts], pa.int64())],
                    names=["id", "n_bytes", "n_tokens"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")

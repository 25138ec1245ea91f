"""A compressed FM-index over words: suffix array, wavelet matrix, matching statistics.

Vectorised over many searches at once; one index holds the texts of one shard.
"""

from __future__ import annotations

import io

import numpy as np

END, GAP = 0, 1  # symbols: end of the text, gap between pieces; words start at 2


def suffix_array(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, lcp) of a sequence that ends in a unique smallest symbol, by prefix doubling.
    lcp[i] is the common length of the suffixes at i - 1 and i; the names kept from each doubling give
    it by halving steps."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype("i8")
    names, k = [rank], 1
    while True:
        key = rank * (n + 1)
        key[:n - k if k < n else 0] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.zeros(n, dtype="i8")
        rank[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
        if rank[order[-1]] == n - 1 or k >= n:
            break
        names.append(rank)
        k *= 2
    lcp = np.zeros(n + 1, dtype="i4")
    a, b, length = order[:-1].copy(), order[1:].copy(), np.zeros(n - 1, dtype="i8")
    for j in range(len(names) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, dtype=bool)
        same[inside] = names[j][a[inside]] == names[j][b[inside]]
        step = same * (1 << j)
        a, b, length = a + step, b + step, length + step
    lcp[1:n] = length
    return order, lcp


class Wavelet:
    """Wavelet matrix with ranks in packed words."""

    def __init__(self, bits: np.ndarray, zeros: np.ndarray):
        self.bits, self.zeros = bits, zeros
        counts = np.bitwise_count(bits).astype("i8")
        self.before = np.concatenate([np.zeros((len(bits), 1), dtype="i8"),
                                      np.cumsum(counts, axis=1)[:, :-1]], axis=1)

    @classmethod
    def of(cls, seq: np.ndarray, symbols: int) -> Wavelet:
        levels = max(1, int(symbols - 1).bit_length())
        words = len(seq) // 64 + 1
        bits, zeros = np.zeros((levels, words), dtype="u8"), np.zeros(levels, dtype="i8")
        for level in range(levels):
            bit = (seq >> (levels - 1 - level)) & 1
            packed = np.packbits(np.append(bit, np.zeros(words * 64 - len(seq), dtype=bit.dtype))
                                 .astype("u1"), bitorder="little")
            bits[level] = packed.view("<u8")
            zeros[level] = len(seq) - bit.sum()
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        return cls(bits, zeros)

    def down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the border ``at`` arrives on the way of ``symbol``; borders of one symbol differ by
        the number of its occurrences between them."""
        levels = len(self.zeros)
        for level in range(levels):
            word = at >> 6
            low = (np.uint64(1) << (at & 63).astype("u8")) - np.uint64(1)
            ones = self.before[level][word] + np.bitwise_count(self.bits[level][word] & low)
            bit = (symbol >> (levels - 1 - level)) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at


class FmIndex:
    """Index of pieces (arrays of 64-bit word hashes), each with the id of its document."""

    def __init__(self, vocabulary, first, lcp, low, window, wavelet: Wavelet):
        self.vocabulary, self.first, self.lcp, self.low = vocabulary, first, lcp, low
        self.window, self.wavelet, self.n = window, wavelet, len(lcp) - 1
        self.counts = np.diff(np.append(first, self.n))
        symbols = np.arange(len(first))
        self.base = self.first - wavelet.down(symbols, np.zeros(len(first), dtype="i8"))
        # per length below the window, the interval of the suffixes that agree in so many words
        self.lows = np.zeros((window, self.n), dtype="i4")
        self.highs = np.full((window, self.n), self.n, dtype="i4")
        places = np.arange(self.n, dtype="i4")
        for length in range(1, window):
            new = lcp[:self.n] < length
            new[0] = True
            self.lows[length] = np.maximum.accumulate(np.where(new, places, 0))
            ends = np.append(np.where(new, places, self.n)[1:], self.n)
            self.highs[length] = np.minimum.accumulate(ends[::-1])[::-1]

    @classmethod
    def build(cls, pieces: list, docs: list, window: int) -> FmIndex:
        hashes = np.concatenate(pieces) if pieces else np.zeros(0, dtype="u8")
        vocabulary, ids = np.unique(hashes, return_inverse=True)
        lengths = np.array([len(p) for p in pieces], dtype="i8")
        starts = np.cumsum(lengths + 1) - (lengths + 1)
        seq = np.full(len(hashes) + len(pieces) + 1, GAP, dtype="i8")
        owner = np.full(len(seq), np.iinfo("i8").max)
        for s, n, at, d in zip(starts, lengths, np.cumsum(lengths) - lengths, docs):
            seq[s:s + n] = ids[at:at + n] + 2
            owner[s:s + n] = d
        seq[-1] = END
        order, lcp = suffix_array(seq)
        symbols = len(vocabulary) + 2
        counts = np.bincount(seq, minlength=symbols)
        first = np.cumsum(counts) - counts
        wavelet = Wavelet.of(seq[order - 1], symbols)  # the symbol before each suffix
        # smallest document among the suffixes that agree in the first ``window`` words
        new = np.flatnonzero(np.append(True, lcp[1:len(seq)] < window))
        low = np.repeat(np.minimum.reduceat(owner[order], new), np.diff(np.append(new, len(seq))))
        return cls(vocabulary, first, lcp, low, window, wavelet)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, vocabulary=self.vocabulary, first=self.first, lcp=self.lcp,
                            low=self.low, window=self.window, bits=self.wavelet.bits,
                            zeros=self.wavelet.zeros)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> FmIndex:
        z = np.load(io.BytesIO(data))
        return cls(z["vocabulary"], z["first"], z["lcp"], z["low"], int(z["window"]),
                   Wavelet(z["bits"], z["zeros"]))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words; -1 for a word that the index does not have."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, dtype="i8")
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 2, -1)

    def extend(self, symbol, lo, hi):
        """The intervals of the matches with ``symbol`` put before them; empty where there is none."""
        both = self.wavelet.down(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.base[symbol]
        return both[:len(symbol)] + base, both[len(symbol):] + base

    def search(self, texts: list, report) -> None:
        """Matching statistics of many texts (arrays of word hashes), from right to left, all texts
        in step. ``report(text numbers, places, smallest documents)`` gets every place at which the
        longest match reaches the window."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order], dtype="i8")
        if not len(lengths) or not lengths[0]:
            return
        symbols = np.full((len(order), lengths[0]), -1, dtype="i4")  # last word first
        for row, i in enumerate(order):
            symbols[row, :lengths[row]] = self.symbols(texts[i])[::-1]
        names = np.array(order)
        lo = np.zeros(len(order), dtype="i8")
        hi, length = np.full(len(order), self.n), np.zeros(len(order), dtype="i8")
        for step in range(lengths[0]):
            live = int(np.searchsorted(-lengths, -step, side="left"))
            c = symbols[:live, step].astype("i8")
            gone = np.flatnonzero(c < 0)
            lo[gone], hi[gone], length[gone] = 0, self.n, 0
            todo = np.flatnonzero(c >= 0)
            new_lo, new_hi = self.extend(c[todo], lo[todo], hi[todo])
            hit = new_lo < new_hi
            at = todo[hit]
            lo[at], hi[at], length[at] = new_lo[hit], new_hi[hit], length[at] + 1
            # where the whole match cannot be extended, the longest part of it that can, by halving
            todo = todo[~hit]
            place, least, most = lo[todo], np.zeros(len(todo), dtype="i8"), length[todo] - 1
            best_lo, best_hi = self.first[c[todo]], self.first[c[todo]] + self.counts[c[todo]]
            open_ = np.flatnonzero(least < most)
            while len(open_):
                middle = (least[open_] + most[open_] + 1) // 2
                new_lo, new_hi = self.extend(c[todo[open_]], self.lows[middle, place[open_]],
                                             self.highs[middle, place[open_]])
                hit = new_lo < new_hi
                at = open_[hit]
                least[at], best_lo[at], best_hi[at] = middle[hit], new_lo[hit], new_hi[hit]
                most[open_[~hit]] = middle[~hit] - 1
                open_ = np.flatnonzero(least < most)
            lo[todo], hi[todo], length[todo] = best_lo, best_hi, least + 1
            full = np.flatnonzero(length[:live] >= self.window)
            if len(full):
                report(names[full], lengths[full] - 1 - step, self.low[lo[full]])
                # no longer match than the window is of use: go on with all but its last word
                length[full] = self.window - 1
                lo[full], hi[full] = self.lows[-1, lo[full]], self.highs[-1, lo[full]]

"""A compressed full-text index over strings of whole numbers: Burrows-Wheeler transform, wavelet matrix, backward search.

Everything is vectorised over many queries at a time: a step of the search extends all open matches by one symbol.
"""

import numpy as np

#: What `FMIndex.owners` gives where a window does not occur.
NOBODY = np.iinfo(np.int64).max


class Bits:
    """A bit vector in words of 64 with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        room = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        room[:len(bits)] = bits
        self.words = np.packbits(room, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Symbols as one bit vector per binary digit, highest first; after each digit zeros go before ones."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.digits = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        self.levels: list[tuple[Bits, int]] = []
        for d in self.digits:
            one = (symbols >> d) & 1 == 1
            self.levels.append((Bits(one), int(len(one) - one.sum())))
            symbols = np.concatenate((symbols[~one], symbols[one]))
        known = np.arange(largest + 1)
        self.base = self._follow(known, np.zeros(largest + 1, np.int64))

    def _follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for d, (bits, zeros) in zip(self.digits, self.levels):
            ones = bits.rank(at)
            at = np.where((symbol >> d) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._follow(symbol, at) - self.base[symbol]


def runs(key: np.ndarray) -> np.ndarray:
    """Numbers of runs of equal keys."""
    return np.cumsum(np.concatenate((np.zeros(1, np.int64), (key[1:] != key[:-1]).astype(np.int64))))


def suffixes(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a text whose strings end in symbols that occur once.

    Ranks by a known number of symbols are put side by side, as many as fit a word, until all differ.
    """
    rank, span = text, 1
    while True:
        bits = max(1, int(rank.max()).bit_length())
        parts = max(2, min(8, 63 // bits))
        key = rank.copy()
        for j in range(1, parts):
            key <<= bits
            later = rank[j * span:]
            key[:len(later)] |= later
        order = np.argsort(key)
        number = runs(key[order])
        if number[-1] == len(text) - 1:
            return order
        rank = np.empty(len(text), np.int64)
        rank[order] = number
        span *= parts


class FMIndex:
    """The index of some strings, each with an owner.

    Held are the transform in a wavelet matrix, the first place of each symbol, a bit where suffixes begin that differ from the one
    before in their first `width` symbols, and the smallest owner of each such block: no suffix array and no text.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, owners: np.ndarray, width: int):
        count, total = len(lengths), int(lengths.sum())
        self.width, self.size = width, total + count
        self.alphabet, known = np.unique(symbols, return_inverse=True)
        text = np.empty(self.size, np.int64)
        ends = np.cumsum(lengths + 1) - 1
        inside = np.ones(self.size, bool)
        inside[ends] = False
        text[ends] = np.arange(count)  # the end of a string is a symbol of its own, below all words
        text[inside] = count + known.ravel()
        order = suffixes(text)
        before = np.maximum(text[order - 1] - count + 1, 0)  # 0 for all ends: no query holds one
        self.matrix = WaveletMatrix(before, len(self.alphabet))
        seen = np.bincount(text[inside] - count + 1, minlength=len(self.alphabet) + 1)
        seen[0] = count
        self.first = np.cumsum(seen) - seen
        same = np.arange(1, self.size)
        for i in range(width):
            same = same[text[order[same] + i] == text[order[same - 1] + i]]
        heads = np.ones(self.size, bool)
        heads[same] = False
        self.heads, self.starts = Bits(heads), np.append(np.flatnonzero(heads), self.size)
        of_string = np.repeat(np.arange(count), lengths + 1)
        self.least = np.minimum.reduceat(owners[of_string[order]], self.starts[:-1])

    def owners(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each window of `width` symbols of the strings, in order, the smallest owner of a string that holds it, or `NOBODY`.

        The match of a string is extended to the left. A match longer than a window is cut back to the block of its first `width`
        symbols; one that cannot be extended loses its last symbol and is searched anew.
        """
        width = self.width
        code = np.searchsorted(self.alphabet, symbols)
        code[code == len(self.alphabet)] = 0
        code = np.where(self.alphabet[code] == symbols, code + 1, 0) if len(self.alphabet) else np.zeros(len(symbols), np.int64)
        per_string = np.maximum(lengths - width + 1, 0)
        out = np.full(int(per_string.sum()), NOBODY)
        begin = np.cumsum(lengths) - lengths
        slot = np.cumsum(per_string) - per_string - begin  # of a window, less its place in `symbols`
        live = np.flatnonzero(per_string > 0)
        at, right = begin + lengths, begin + lengths
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.size)
        while len(live):
            at[live] -= 1
            symbol = code[at[live]]
            both = self.matrix.rank(np.concatenate((symbol, symbol)), np.concatenate((low[live], high[live])))
            lo, hi = self.first[symbol] + both[:len(live)], self.first[symbol] + both[len(live):]
            ok = (hi > lo) & (symbol > 0)
            went, stuck = live[ok], live[~ok]
            low[went], high[went] = lo[ok], hi[ok]
            full = went[right[went] - at[went] >= width]
            if len(full):
                block = self.heads.rank(low[full] + 1) - 1
                low[full], high[full], right[full] = self.starts[block], self.starts[block + 1], at[full] + width
                out[slot[full] + at[full]] = self.least[block]
            right[stuck] -= 1
            at[stuck], low[stuck], high[stuck] = right[stuck], 0, self.size
            done = np.where(ok, at[live] == begin[live], right[live] - begin[live] < width)
            live = live[~done]
        return out

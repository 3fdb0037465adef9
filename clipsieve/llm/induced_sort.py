"""Suffix arrays by induced sorting and permuted common prefixes, in whole-array steps.

The strings of a shard are laid end to end, each closed by a separator of its own that is smaller than all
bytes, so no common prefix runs past a string's end. Suffixes are classified (smaller or larger than their right
neighbour), the leftmost smaller ones are sorted by one induction of their substrings, named, and, where names
repeat, sorted as suffixes of the reduced strings by the same means; a second induction gives the suffix array.
A name is written as two digits there, so that a level has few buckets however many names there are, and
names that occur once are left out, so levels are few and short. Induction goes bucket by bucket of the first symbol; inside a
bucket it goes in waves, each a stable split by the preceding symbol, so the work is linear and no step handles
single suffixes. Equal substrings are told by 64 bits of hash among neighbours.
"""

from __future__ import annotations

import numpy as np

#: Reduced strings of at most so many names end the recursion.
SMALL = 1 << 14


class Shard:
    def __init__(self, strings: list[bytes]):
        size = np.array([len(s) for s in strings], np.int64)
        self.bytes = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        self.lay(self.bytes.astype(np.int64), np.cumsum(size + 1) - 1, 256)

    @classmethod
    def of_symbols(cls, symbols: np.ndarray, ends: np.ndarray, kinds: int) -> Shard:
        """Strings of symbols below ``kinds``, laid end to end, each with one more place for its separator at ``ends``."""
        s = cls.__new__(cls)
        s.lay(symbols, ends, kinds)
        return s

    def lay(self, symbols: np.ndarray, ends: np.ndarray, kinds: int) -> None:
        self.n, self.m, self.kinds, self.ends = len(symbols), len(ends), kinds, ends
        self.start = np.concatenate([[0], ends + 1])[:-1]
        self.text = symbols + self.m
        self.text[ends] = np.arange(self.m)

    def types(self) -> np.ndarray:
        """Which suffixes are smaller than their right neighbour; the last is."""
        t, n = self.text, self.n
        diff = np.zeros(n, np.int8)
        diff[:-1] = np.sign(t[1:] - t[:-1])
        diff[-1] = 1
        # within a run of equal symbols the type is that of the run's last
        at = np.where(diff != 0, np.arange(n), n)
        nxt = np.minimum.accumulate(at[::-1])[::-1]
        return diff[nxt] > 0

    def induce(self, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
        """The suffix array that the leftmost smaller suffixes in this order induce."""
        t, m, n, kinds = self.text, self.m, self.n, self.kinds
        rest = lms[t[lms] >= m]
        rest = rest[np.argsort(t[rest], kind="stable")]
        cut = np.searchsorted(t[rest], np.arange(m, m + kinds + 1))
        bits = np.uint8 if kinds <= 256 else np.uint16
        inner = t >= m

        def buckets(of: np.ndarray):
            """Room for the suffixes of one type, laid out by first symbol, where each symbol's begin, and up to where they are filled."""
            start = np.concatenate([[0], np.cumsum(np.bincount(t[of & inner] - m, minlength=kinds))])
            return np.zeros(start[-1], np.int64), start, start[:-1].copy()

        def push(places: np.ndarray, want: bool, room: np.ndarray, filled: np.ndarray) -> None:
            """Appends the places before these, of the wanted type, to the buckets of their symbols."""
            before = places[places > 0] - 1
            before = before[(small[before] == want) & inner[before]]
            if not len(before):
                return
            sym = (t[before] - m).astype(bits)
            order = np.argsort(sym, kind="stable")
            before, sym = before[order], sym[order]
            count = np.bincount(sym, minlength=kinds)
            room[(filled - np.cumsum(count) + count)[sym] + np.arange(len(sym))] = before
            filled += count

        def waves(c: int, want: bool, room: np.ndarray, start: np.ndarray, filled: np.ndarray) -> None:
            """Pushes what waits in a bucket, as one wave, until no wave adds to the bucket itself."""
            done = start[c]
            while done < filled[c]:
                done, wave = filled[c], room[done : filled[c]]
                push(wave, want, room, filled)

        larger, less = buckets(~small), buckets(small)
        push(self.ends, False, larger[0], larger[2])  # a separator's suffix is ranked by the separator alone
        for c in range(kinds):
            waves(c, False, *larger)
            push(rest[cut[c] : cut[c + 1]], False, larger[0], larger[2])
        part = lambda of, c: of[0][of[1][c] : of[1][c + 1]]
        for c in range(kinds - 1, -1, -1):
            waves(c, True, *less)
            push(part(larger, c)[::-1], True, less[0], less[2])
        sa = np.concatenate([self.ends, *(x for c in range(kinds) for x in (part(larger, c), part(less, c)[::-1]))])
        assert len(sa) == n
        return sa

    def suffix_array(self) -> np.ndarray:
        small = self.types()
        is_lms = small.copy()
        is_lms[0] = False
        is_lms[1:] &= ~small[:-1]
        is_lms[self.ends] = True  # separators close every substring
        lms = np.flatnonzero(is_lms)
        sa = self.induce(small, lms)
        ranked = sa[is_lms[sa]]
        # equal substrings get one name; a separator is unique, so substrings that reach one are too
        upto = np.full(self.n, self.n, np.int64)
        upto[lms[:-1]] = lms[1:]
        weight = np.cumprod(np.full(self.n + 1, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
        value = (self.text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
        value ^= value >> np.uint64(29)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * weight[: self.n], dtype=np.uint64)])
        end = np.minimum(upto[ranked] + 1, self.n)
        # the sum over [i, e) scaled to a common power, so equal substrings agree wherever they stand
        code = (sums[end] - sums[ranked]) * weight[self.n - ranked]
        length = end - ranked
        new = np.append(True, (code[1:] != code[:-1]) | (length[1:] != length[:-1]))
        name = np.cumsum(new) - 1
        if not new.all():
            ranked = lms[self.reduced(lms, ranked, name)]
        return self.induce(small, ranked)

    def reduced(self, lms: np.ndarray, ranked: np.ndarray, name: np.ndarray) -> np.ndarray:
        """Order of the suffixes that begin at ``lms``, from the names of their substrings.

        A name that occurs once settles its suffix and ends every comparison that comes to it, so of a run of such names
        only the first is laid into the string below. Separators keep their order, all others are written as two digits."""
        once = np.bincount(name)[name] == 1
        named, single = np.zeros(self.n, np.int64), np.zeros(self.n, bool)
        named[ranked], single[ranked] = name, once
        value, alone = named[lms], single[lms]
        stay = ~alone
        stay[1:] |= ~alone[:-1]
        stay[-1] = True
        value = value[stay]
        ends = value < self.m  # the separators have the first names
        rank = np.zeros(int(name[-1]) + 1, np.int64)
        rank[value[~ends]] = 1
        rank = np.cumsum(rank) - 1
        base = max(2, int(np.ceil(np.sqrt(rank[-1] + 1))))
        width = np.where(ends, 1, 2)
        at = np.cumsum(width) - width
        symbols = np.zeros(int(width.sum()), np.int64)
        symbols[at[~ends]], symbols[at[~ends] + 1] = rank[value[~ends]] // base, rank[value[~ends]] % base
        if len(value) <= SMALL:
            order = np.flatnonzero(stay)[doubled(value)]
        else:
            below = Shard.of_symbols(symbols, at[ends], base).suffix_array()
            which = np.full(len(symbols), -1, np.int64)
            which[at] = np.flatnonzero(stay)
            order = which[below]
            order = order[order >= 0]
        out = np.searchsorted(lms, ranked)
        out[~once] = order[~alone[order]]
        return out

    def common_prefixes(self, sa: np.ndarray) -> np.ndarray:
        """For each text place, the common prefix of its suffix and the one before it in ``sa``."""
        n, t = self.n, self.text
        phi = np.full(n, -1, np.int64)
        phi[sa[1:]] = sa[:-1]
        before = np.full(n, -1, np.int64)
        before[1:] = t[:-1]
        other = np.where(phi > 0, t[np.maximum(phi - 1, 0)], -2)
        odd = np.flatnonzero((phi >= 0) & (before != other))  # not the previous place's prefix less one
        seen = np.zeros(len(odd), np.int64)
        live = np.arange(len(odd))
        room = np.full(n + 1, 0, np.int64)
        ends = np.repeat(self.ends, np.diff(np.append(self.start, n)))
        room[:n] = ends - np.arange(n)
        padded = np.concatenate([self.bytes, np.zeros(16, np.uint8)])
        words = np.ndarray((n + 8,), "<u8", padded.tobytes(), strides=(1,))
        while len(live):
            i, j = odd[live] + seen[live], phi[odd[live]] + seen[live]
            left = np.minimum(room[i], room[j])
            x = words[i] ^ words[j]
            low = x & (~x + np.uint64(1))
            same = np.where(x == 0, 8, (np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)) // 8).astype(np.int64))
            got = np.minimum(same, left)
            seen[live] += got
            live = live[got == 8]
        reach = np.zeros(n, np.int64)
        reach[odd] = odd + seen
        reach = np.maximum.accumulate(np.maximum(reach, np.arange(n)))
        return np.where(phi >= 0, reach - np.arange(n), 0)


def doubled(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a short string of ranks, by doubling."""
    n, step = len(s), 1
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        k = key[order]
        rank[order] = np.append(0, np.cumsum(k[1:] != k[:-1]))
        if step >= n or rank.max() == n - 1:
            return order
        step *= 2

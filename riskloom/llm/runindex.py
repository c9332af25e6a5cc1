"""Run-length compressed Burrows-Wheeler index of a text, and matching statistics streamed through it."""

from __future__ import annotations

import numpy as np

#: Byte values of indexed texts are raised by one; this value ends every piece and is in none.
END = 0


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start places of all suffixes of `text` (uint8) in order, by prefix doubling from eight bytes on; only ties are sorted again."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    word = np.ndarray((n,), ">u8", padded, 0, (1,)).astype(np.uint64)
    sa = np.argsort(word)
    word = word[sa]
    starts = np.concatenate(([True], word[1:] != word[:-1]))
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    reach = 8
    tied = np.flatnonzero(~(starts & np.concatenate((starts[1:], [True]))))
    while len(tied):
        place = sa[tied]
        beyond = place + reach
        key = (rank[place] << 32) | np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        order = np.argsort(key)
        place, key = place[order], key[order]
        sa[tied] = place
        starts = np.concatenate(([True], key[1:] != key[:-1]))
        rank[place] = tied[np.maximum.accumulate(np.where(starts, np.arange(len(tied)), 0))]
        tied = tied[~(starts & np.concatenate((starts[1:], [True])))]
        reach *= 2
    return sa


class RunIndex:
    """The Burrows-Wheeler transform of pieces as runs of equal letters, with the text place at both ends of every run.

    `text`: uint8 letters, each piece followed by END. Rows are suffixes in order. Held are per run its first row, letter, first row of its
    letters in the sorted column, and the text places of its first and last row; nothing is kept per row. The text itself is kept to
    compare two places.
    """

    def __init__(self, text: np.ndarray, cap: int):
        self.cap = cap
        self.sa = suffix_array(text)  # only until `release`
        n = len(text)
        padded = np.concatenate((text, np.zeros(cap + 16, np.uint8)))
        self.word = np.ndarray((n + cap + 8,), "<u8", padded, 0, (1,)).copy()
        before = text[self.sa - 1]
        self.row = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        last = np.concatenate((self.row[1:], [n])) - 1
        self.letter = before[self.row].astype(np.int64)
        self.first, self.last = self.sa[self.row], self.sa[last]
        self.last_row = last
        size = last - self.row + 1
        runs = len(self.row)
        self.by_letter = np.argsort(self.letter, kind="stable")
        self.key = self.letter[self.by_letter] * runs + self.by_letter
        self.lf = np.empty(runs, np.int64)  # rows sorted by letter, then by run: the running total is the place in the sorted column
        self.lf[self.by_letter] = np.concatenate(([0], np.cumsum(size[self.by_letter])[:-1]))
        self.of_letter = np.searchsorted(self.letter[self.by_letter], np.arange(258))

    def release(self) -> None:
        """Forget the sorted suffixes; what is left is proportional to the runs, and the text."""
        self.sa = None

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Number of equal letters at text places a and b, up to `limit`."""
        out = limit.copy()
        open_, d = np.flatnonzero(limit > 0), 0
        while len(open_):
            x = self.word[a[open_] + d] ^ self.word[b[open_] + d]
            apart = x != 0
            if apart.any():
                hit, bits = open_[apart], x[apart]
                same = np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3
                out[hit] = np.minimum(out[hit], d + same)
                open_ = open_[~apart]
            d += 8
            open_ = open_[limit[open_] > d]
        return out

    def matching_statistics(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each place of `letters` the length of the longest match, up to `cap`, of what starts there (to the end of its pattern) in the text.

        Patterns letters[starts[k]:ends[k]] are read from their ends, all side by side. A row follows its letter by the LF step; where the row's run has another
        letter, the row jumps to the end of the run of that letter before it or to the start of the one after it, whichever shares
        more letters with the suffix it stood on.
        """
        out = np.zeros(len(letters), np.int64)
        order = np.argsort(starts - ends, kind="stable")
        end, size = ends[order], (ends - starts)[order]
        row, place, length = (np.zeros(len(order), np.int64) for _ in range(3))
        runs, live = len(self.row), len(order)
        if not runs:
            return out
        place[:] = self.first[0]
        for step in range(int(size[0]) if live else 0):
            while size[live - 1] <= step:
                live -= 1
            at = end[:live] - 1 - step
            c = letters[at].astype(np.int64)
            r, q, p, n = row[:live], None, place[:live], length[:live]
            run = np.searchsorted(self.row, r, "right") - 1
            jump = np.flatnonzero(self.letter[run] != c)
            known = np.ones(live, bool)
            if len(jump):
                cj = c[jump]
                k = np.searchsorted(self.key, cj * runs + run[jump])
                after, before = k < self.of_letter[cj + 1], k > self.of_letter[cj]
                up, down = self.by_letter[np.minimum(k, runs - 1)], self.by_letter[np.maximum(k - 1, 0)]
                limit, here = n[jump], p[jump]
                shared_up = np.where(after, self.common(self.first[up], here, np.where(after, limit, 0)), -1)
                shared_down = np.where(before, self.common(self.last[down], here, np.where(before, limit, 0)), -1)
                take = shared_up >= shared_down
                run[jump] = np.where(take, up, down)
                r[jump] = np.where(take, self.row[up], self.last_row[down])
                p[jump] = np.where(take, self.first[up], self.last[down])
                n[jump] = np.maximum(np.where(take, shared_up, shared_down), 0)
                known[jump] = after | before
            q = self.lf[run] + r - self.row[run]
            if known.all():
                r[:], p[:], n[:] = q, p - 1, np.minimum(n + 1, self.cap)
            else:  # the letter is not in the text: start again from anywhere
                r[:], p[:], n[:] = np.where(known, q, 0), np.where(known, p - 1, self.first[0]), np.where(known, np.minimum(n + 1, self.cap), 0)
            out[at] = n
        return out

    def repeats(self) -> np.ndarray:
        """For each text place whether the `cap` letters there also start at a smaller place; needs the sorted suffixes."""
        n = len(self.sa)
        out = np.zeros(n, bool)
        if n < 2:
            return out
        to_end = np.flatnonzero((self.word[:n] & np.uint64(255)) == END)
        room = np.concatenate((np.repeat(to_end, np.diff(np.concatenate(([-1], to_end)))), np.zeros(n, np.int64)))[:n] - np.arange(n)
        full = room >= self.cap
        rows = np.flatnonzero(full[self.sa[1:]] & full[self.sa[:-1]]) + 1
        equal = np.zeros(n, bool)
        equal[rows] = self.common(self.sa[rows - 1], self.sa[rows], np.full(len(rows), self.cap)) == self.cap
        rows = np.flatnonzero(equal | np.concatenate((equal[1:], [False])))
        if len(rows):
            first = np.flatnonzero(~equal[rows])
            group = np.repeat(np.arange(len(first)), np.diff(np.concatenate((first, [len(rows)]))))
            place = self.sa[rows]
            out[place[place > np.minimum.reduceat(place, first)[group]]] = True
        return out

"""Suffix arrays of byte strings in numpy, by two-stage sorting."""

from __future__ import annotations

import numpy as np

#: Marks the end of each string; text bytes are moved up by one, which UTF-8 leaves room for.
END = 0


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All strings with an END after each, and where each starts."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8) + np.uint8(1)
    return text, np.cumsum(sizes) - sizes


def _keys(text: np.ndarray) -> np.ndarray:
    """Eight characters from each position as one number; nothing counts after an END."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    keys = np.zeros(len(text), np.uint64)
    open_ = np.ones(len(text), bool)
    for k in range(8):
        char = padded[k : k + len(text)]
        open_ &= char != END
        keys = (keys << np.uint64(8)) | np.where(open_, char, END).astype(np.uint64)
    return keys


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a character later. ENDs count as smaller."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    step[text == END] = 1
    # equal neighbours are as their run's last character
    known = np.where(step != 0, np.arange(n), n - 1)
    known = np.minimum.accumulate(known[::-1])[::-1]
    return step[known] > 0


def _sorted_directly(at: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """``at`` by the first ``depth`` characters of their suffixes: rounds of eight characters on what is still equal."""
    order = at[np.argsort(keys[at], kind="stable")]
    first = keys[order]
    group = np.cumsum(np.r_[True, first[1:] != first[:-1]]) if len(order) else np.zeros(0, np.int64)
    live = np.arange(len(order))
    shift = 0
    while shift + 8 < depth and len(live):
        g, p = group[live], order[live]
        key = keys[p + shift]
        more = (key & np.uint64(255)) != END  # the others have ended
        twin = np.r_[False, g[1:] == g[:-1]] | np.r_[g[1:] == g[:-1], False]
        live = live[more & twin]
        shift += 8
        if not len(live):
            break
        g, p = group[live], order[live]
        key = keys[np.minimum(p + shift, len(keys) - 1)]
        by = np.lexsort((key, g))
        order[live] = p[by]
        key, g = key[by], g[by]
        fresh = np.r_[True, (g[1:] != g[:-1]) | (key[1:] != key[:-1])]
        group[live] = np.cumsum(fresh) + group[-1] + 1 + shift * len(order)
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` characters; ENDs come first.

    Only the suffixes that are smaller than their successors are sorted. Then the buckets of first characters
    are scanned from the smallest: a larger suffix follows from its successor, which is in place by then, and
    is appended to the larger ones of its own bucket; runs of one character are scanned round by round.
    """
    small = smaller_than_next(text)
    direct = _sorted_directly(np.flatnonzero(small & (text != END)), _keys(text), depth)
    direct_of = np.searchsorted(text[direct], np.arange(258))
    grown: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []

    def induce(found: np.ndarray, own: int) -> np.ndarray:
        """Predecessors of ``found`` that are larger than it, dealt to their buckets; those in ``own`` are returned."""
        before = found[found > 0] - 1
        before = before[~small[before] & (text[before] != END)]
        chars = text[before]
        same = before[chars == own]
        rest, chars = before[chars != own], chars[chars != own]
        if not len(rest):
            return same
        by = np.argsort(chars, kind="stable")
        rest, chars = rest[by], chars[by]
        cuts = np.flatnonzero(np.r_[True, chars[1:] != chars[:-1]])
        for a, b in zip(cuts, np.r_[cuts[1:], len(rest)], strict=True):
            grown[int(chars[a])].append(rest[a:b])
        return same

    ends = np.flatnonzero(text == END)
    out.append(ends)
    induce(ends, END)
    for char in range(1, 257):
        waiting = grown[char]
        while waiting:
            found = np.concatenate(waiting)
            out.append(found)
            same = induce(found, char)
            waiting = [same] if len(same) else []
        block = direct[direct_of[char] : direct_of[char + 1]]
        if len(block):
            out.append(block)
            induce(block, char)
    return np.concatenate(out)


def repeated(text: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` characters from each position also start elsewhere, without an END among them.

    In the suffix array equal strings are neighbours, with a common prefix of ``length`` at least.
    """
    n = len(text)
    marks = np.flatnonzero(text == END)
    room = np.repeat(marks, np.diff(np.r_[-1, marks])) - np.arange(n) >= length
    order = suffix_array(text, length)
    order = order[room[order]]
    out = np.zeros(n, bool)
    if len(order) < 2:
        return out
    keys = _keys(text)
    upper, lower = order[:-1], order[1:]
    for at in [*range(0, length - 7, 8), length - 8]:
        equal = keys[upper + at] == keys[lower + at]
        upper, lower = upper[equal], lower[equal]
    out[upper] = out[lower] = True
    return out

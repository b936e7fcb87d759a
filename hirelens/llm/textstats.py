"""Statistics of whole texts, computed for many texts at once."""

from __future__ import annotations

import numpy as np

from hirelens.llm.common import sums
from hirelens.llm.textops import Words, mix, span_hashes, window_hashes

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.array([33 <= b < 127 and not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123) for b in range(256)])


def group_sizes(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each hash occurs in its row; and whether it is the first such in order."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    key = hashes ^ mix(rows.astype(np.uint64) + np.uint64(1))
    _, index, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    first = np.zeros(len(key), bool)
    first[index] = True
    return count[inverse], first


def repeated_words(w: Words, size: int = 5) -> np.ndarray:
    """Words of each text that lie in windows of ``size`` words found twice or more in it."""
    rows = w.rows()
    at = w.window_starts(size)
    count, _ = group_sizes(rows[at], window_hashes(w.hashes, size)[at])
    edge = np.zeros(len(rows) + 1, np.int64)
    again = at[count > 1]
    np.add.at(edge, again, 1)
    np.add.at(edge, again + size, -1)
    return sums((np.cumsum(edge)[:-1] > 0).astype(np.int64), w.first)


def lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, words) of every line that has a word."""
    n = len(w.raw)
    cut = np.flatnonzero(w.raw == 10)
    # a line goes from a text's start or a line feed to the next line feed or the text's end
    starts = np.unique(np.concatenate((w.offs[:-1], cut + 1)))
    starts = starts[starts < n]
    ends = np.minimum(np.append(cut, n)[np.searchsorted(cut, starts)], w.offs[np.searchsorted(w.offs, starts, side="right")])
    words = np.searchsorted(w.starts, ends) - np.searchsorted(w.starts, starts)
    keep = words > 0
    starts, ends, words = starts[keep], ends[keep], words[keep]
    rows = np.searchsorted(w.offs, starts, side="right") - 1
    return rows, span_hashes(w.raw, starts, ends) if len(starts) else np.zeros(0, np.uint64), words


def base_stats(w: Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = len(w.offs) - 1
    points = np.concatenate(([0], np.cumsum((w.raw & 0xC0) != 0x80)))
    line_rows, line_hash, _ = lines(w)
    _, first = group_sizes(line_rows, line_hash)
    return {
        "n_words": w.counts(),
        "word_chars": sums(points[w.ends] - points[w.starts], w.first),
        "n_symbols": sums(_SYMBOL[w.raw].astype(np.int64), w.offs),
        "n_dup_lines": np.bincount(line_rows[~first], minlength=n),
        "n_repeat_words": repeated_words(w),
    }


#: Statistics that quality rules look at, in the order of ``quality_stats``.
STATS = ("words", "word_bytes", "longest_word", "upper_share", "symbol_share", "digit_share", "punct_share", "high_share",
         "distinct_share", "top_word_share", "same_as_last_share", "repeat_share", "line_words", "dup_line_share",
         "shout_share", "letterless_share")


def quality_stats(w: Words) -> dict[str, np.ndarray]:
    """The statistics in ``STATS`` of each text; shares are 0 where there is nothing to share."""
    n = len(w.offs) - 1
    words, rows = w.counts(), w.rows()
    share = lambda x, total: x / np.maximum(total, 1)
    of = lambda mark: sums(mark[w.raw].astype(np.int64), w.offs)
    lower, upper = of(_LOWER), of(_UPPER)
    sizes = w.ends - w.starts
    inside = sums(sizes, w.first)
    longest = np.zeros(n)
    full = words > 0
    if full.any():
        longest[full] = np.maximum.reduceat(sizes, w.first[:-1][full])
    count, first = group_sizes(rows, w.hashes)
    top = np.zeros(n)
    if full.any():
        top[full] = np.maximum.reduceat(count, w.first[:-1][full])
    same = np.zeros(len(rows), np.int64)
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (rows[1:] == rows[:-1])
    line_rows, line_hash, _ = lines(w)
    _, first_line = group_sizes(line_rows, line_hash)
    n_lines = np.bincount(line_rows, minlength=n)
    ups = np.concatenate(([0], np.cumsum(_UPPER[w.raw])))
    lows = np.concatenate(([0], np.cumsum(_LOWER[w.raw] | (w.raw >= 128))))
    word_up, word_low = ups[w.ends] - ups[w.starts], lows[w.ends] - lows[w.starts]
    return {
        "words": words.astype(float),
        "word_bytes": share(inside, words),
        "longest_word": longest,
        "upper_share": share(upper, upper + lower),
        "symbol_share": share(of(_SYMBOL), inside),
        "digit_share": share(of(_DIGIT), inside),
        "punct_share": share(of(_PUNCT), inside),
        "high_share": share(sums((w.raw >= 128).astype(np.int64), w.offs), inside),
        "distinct_share": share(sums(first.astype(np.int64), w.first), words),
        "top_word_share": share(top, words),
        "same_as_last_share": share(sums(same, w.first), words),
        "repeat_share": share(repeated_words(w), words),
        "line_words": share(words, n_lines),
        "dup_line_share": share(np.bincount(line_rows[~first_line], minlength=n), n_lines),
        "shout_share": share(sums(((word_up > 1) & (word_low == 0)).astype(np.int64), w.first), words),
        "letterless_share": share(sums(((word_up + word_low) == 0).astype(np.int64), w.first), words),
    }

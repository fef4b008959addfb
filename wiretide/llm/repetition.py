"""Repetition rules by suffix arrays over words.

The suffix array of many texts is sorted at once, each text ending in a mark of its own,
by prefix doubling over the suffixes that still tie. An interval of suffixes with a longest
common prefix is a repeat that no word to the right extends; it is a maximal one if the
words to the left differ too. The spans of maximal repeats are joined. The base counts need
no intervals, only whether a neighbour in the array shares a window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wiretide.llm.common import Words, blocks_of, filter_pass, row_pass, text_table

SYMBOLS = "#*$%&|<>"
#: The base: fewest words, and most percent of words in repeated windows of WINDOW words.
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3
#: The verdict: a repeat counts from LEAST_REPEAT words; most part of the words covered by
#: repeats, and most words of one repeat.
LEAST_REPEAT, MOST_COVERED, LONGEST_REPEAT = 8, 0.3, 200
#: Characters sorted at once.
BLOCK = 1 << 20


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of a sequence of distinct suffixes (each text ends in its own mark).

    Prefix doubling: after a round with step k, ranks order the suffixes by their first
    2k words; only groups that still tie are sorted again.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = np.concatenate([[True], ids[order][1:] != ids[order][:-1]]) if n else np.zeros(0, dtype=bool)
    # The rank of a group is the place of its first suffix, so later splits keep earlier ranks.
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1] if n else 0
    k = 1
    while True:
        tied = ~(first & np.concatenate([first[1:], [True]])) if n else first
        places = np.flatnonzero(tied)
        if not len(places):
            return order, rank
        suffixes = order[places]
        following = np.where(suffixes + k < n, rank[np.minimum(suffixes + k, n - 1)], -1)
        group = rank[suffixes]
        by = np.lexsort((following, group))
        suffixes, following, group = suffixes[by], following[by], group[by]
        order[places] = suffixes
        starts = np.concatenate([[True], (group[1:] != group[:-1]) | (following[1:] != following[:-1])])
        first[places] = starts
        rank[suffixes] = places[np.flatnonzero(starts)[np.cumsum(starts) - 1]]
        k *= 2


def common_prefixes(ids: np.ndarray, order: np.ndarray, least: int = 1) -> np.ndarray:
    """lcp[i]: words that suffixes order[i - 1] and order[i] share; 0 where fewer than `least`.

    All neighbours are compared at once, each until it differs: steps double while
    blocks agree (by prefix hashes), then halve. Marks never agree.
    """
    n = len(ids)
    out = np.zeros(n, dtype=np.int64)
    if n < 2:
        return out
    from wiretide.llm.common import U64, mix64

    base = U64(0x9E3779B97F4A7C15)
    powers = np.concatenate([np.ones(1, dtype=U64), np.cumprod(np.full(n, base, dtype=U64), dtype=U64)])
    prefix = np.concatenate([np.zeros(1, dtype=U64), np.cumsum(mix64(ids.astype(U64)) * powers[:n], dtype=U64)])
    left, right = order[:-1], order[1:]
    candidates = np.arange(n - 1)
    if least > 1:
        end = np.maximum(left, right) + least
        candidates = candidates[end <= n]
        a, b = left[candidates], right[candidates]
        candidates = candidates[_agree(prefix, powers, a, b, least)]
    else:
        candidates = candidates[ids[left] == ids[right]]
    length = np.full(len(candidates), max(least, 1))
    step = 1
    growing = np.arange(len(candidates))
    steps = np.zeros(len(candidates), dtype=np.int64)
    while len(growing):
        a, b = left[candidates[growing]] + length[growing], right[candidates[growing]] + length[growing]
        fits = np.maximum(a, b) + step <= n
        same = np.zeros(len(growing), dtype=bool)
        same[fits] = _agree(prefix, powers, a[fits], b[fits], step)
        length[growing[same]] += step
        steps[growing[~same]] = step
        growing = growing[same]
        step *= 2
    step = int(steps.max(initial=1)) // 2
    while step >= 1:
        live = np.flatnonzero(steps > step)
        a, b = left[candidates[live]] + length[live], right[candidates[live]] + length[live]
        fits = np.maximum(a, b) + step <= n
        same = np.zeros(len(live), dtype=bool)
        same[fits] = _agree(prefix, powers, a[fits], b[fits], step)
        length[live[same]] += step
        step //= 2
    out[candidates + 1] = length
    return out


def _agree(prefix: np.ndarray, powers: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Whether the n words at a and at b are the same, by their polynomial hashes."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    return (prefix[low + n] - prefix[low]) * powers[high - low] == prefix[high + n] - prefix[high]


@dataclass
class Intervals:
    """Longest-common-prefix intervals: words in common, first and last place in the suffix array, the interval around; and each place's innermost one."""

    height: np.ndarray
    first: np.ndarray
    last: np.ndarray
    outer: np.ndarray
    inner_of: np.ndarray


def lcp_intervals(lcp: np.ndarray, least: int) -> Intervals:
    """All intervals of at least `least` common words, by a stack along each stretch of the array that has them."""
    high = np.concatenate([[False], lcp >= least, [False]])
    edges = np.flatnonzero(high[1:] != high[:-1])
    height, first, last, outer = [], [], [], []
    inner_of = np.full(len(lcp), -1, dtype=np.int64)
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        stack, inner = [], []
        for i, common in enumerate([*lcp[a:b].tolist(), 0], start=a):
            # The place before belongs to what is open at its own height, or to what opens now.
            inner.append(stack[-1] if stack and height[stack[-1]] >= common else len(height))
            begin, closed = i - 1, None
            while stack and height[stack[-1]] > common:
                closed = stack.pop()
                last[closed], begin = i - 1, first[closed]
                outer[closed] = stack[-1] if stack else -1
            if common >= least and (not stack or height[stack[-1]] < common):
                if closed is not None:
                    outer[closed] = len(height)
                stack.append(len(height))
                height.append(common)
                first.append(begin)
                last.append(-1)
                outer.append(-1)
        inner_of[a - 1 : b] = inner
    return Intervals(*(np.array(x, dtype=np.int64) for x in (height, first, last, outer)), inner_of)


def maximal_repeats(sequence: np.ndarray, order: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Per place of the sequence, the words of the longest maximal repeat that starts there; 0 without one of `least` words."""
    found = lcp_intervals(lcp, least)
    out = np.zeros(len(order), dtype=np.int64)
    if not len(found.height):
        return out
    # Words to the left; a text's first word has a mark there, the very first one nothing.
    before = np.where(order > 0, sequence[np.maximum(order - 1, 0)], -1)
    changes = np.cumsum(np.concatenate([[False], before[1:] != before[:-1]]))
    differ = changes[found.last] > changes[found.first]
    longest = np.zeros(len(found.height) + 1, dtype=np.int64)
    for t in np.argsort(found.height, kind="stable").tolist():
        # A repeat that the same word always precedes is part of a longer one; what is around it may be maximal.
        longest[t] = found.height[t] if differ[t] else longest[found.outer[t]]
    inside = found.inner_of >= 0
    out[order[inside]] = longest[found.inner_of[inside]]
    return out


@dataclass
class Repeats:
    """Per text: words in repeated windows, words covered by maximal repeats, words of the longest one."""

    windows: np.ndarray
    covered: np.ndarray
    longest: np.ndarray
    spans: np.ndarray  # first word (within the block) and words of each joined span


def find_repeats(hashes: np.ndarray, starts: np.ndarray, window: int = WINDOW, least: int = LEAST_REPEAT) -> Repeats:
    """Repeats within each text; text i has words starts[i]:starts[i + 1]."""
    texts, n = len(starts) - 1, len(hashes)
    _, ids = np.unique(hashes, return_inverse=True)
    # Text i's words move up by i, and its mark follows them.
    owner = np.repeat(np.arange(texts), np.diff(starts))
    sequence = np.empty(n + texts, dtype=np.int64)
    sequence[np.arange(n) + owner] = ids * np.int64(texts) + owner
    sequence[starts[1:] + np.arange(texts)] = np.int64(n + 1) * texts + np.arange(texts)
    # With the text's number in every word, suffixes of different texts never share a prefix.
    order, _ = suffix_array(sequence)
    lcp = common_prefixes(sequence, order, window)
    # Whether a window repeats: a suffix shares it with one of its two neighbours.
    shared = np.zeros(n + texts, dtype=np.int64)
    shared[order] = np.maximum(lcp, np.concatenate([lcp[1:], [0]]) if len(lcp) else lcp)
    place = np.arange(n) + owner
    at = shared[place]
    long = maximal_repeats(sequence, order, lcp, least)[place]
    longest = np.zeros(texts, dtype=np.int64)
    np.maximum.at(longest, owner, long)
    covered = _cover(np.where(at >= window, window, 0))
    spans = _cover(long)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], spans.astype(np.int8), [0]])))
    joined = np.stack([edges[::2], edges[1::2] - edges[::2]], axis=1)
    count = lambda mask: np.bincount(owner[mask], minlength=texts)
    return Repeats(count(covered), count(spans), longest, joined)


def _cover(lengths: np.ndarray) -> np.ndarray:
    """Which places lie in a span [i, i + lengths[i])."""
    if not len(lengths):
        return np.zeros(0, dtype=bool)
    reach = np.maximum.accumulate(np.arange(len(lengths)) + lengths)
    return reach > np.arange(len(lengths))


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.encode("utf-8", "surrogatepass").strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


COLUMNS = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()


def measure(texts: list) -> dict[str, np.ndarray]:
    """The base counts, and covered words and the longest repeat, of each whole text; null: none."""
    out = {c: np.zeros(len(texts), dtype=np.int64) for c in [*COLUMNS, "covered_words", "longest_repeat"]}
    for begin, end in blocks_of(texts, BLOCK):
        part = texts[begin:end]
        words = Words(part, chars=True)
        found = find_repeats(words.hashes, words.starts)
        sums = np.concatenate([[0], np.cumsum(words.chars)])
        at = slice(begin, end)
        out["n_words"][at] = np.diff(words.starts)
        out["word_chars"][at] = np.diff(sums[words.starts])
        out["n_symbols"][at] = [sum(map(t.count, SYMBOLS)) if t else 0 for t in part]
        out["n_dup_lines"][at] = [duplicate_lines(t) if t else 0 for t in part]
        out["n_repeat_words"][at] = found.windows
        out["covered_words"][at] = found.covered
        out["longest_repeat"][at] = found.longest
    base = (out["n_words"] < LEAST_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEATED_PERCENT * out["n_words"])
    over = (out["covered_words"] > MOST_COVERED * out["n_words"]) | (out["longest_repeat"] > LONGEST_REPEAT)
    out["base_failed"], out["kept"] = base, ~base & ~over
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the base counts, covered_words, longest_repeat, base_failed, kept."""
    names = [*COLUMNS, "covered_words", "longest_repeat"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(batch.column(1).to_pylist())
        columns = [pa.array(found[c]) for c in [*names, "base_failed", "kept"]]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names, "base_failed", "kept"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, kept boolean"
    return row_pass(text_table(docs, id_col, text_col), work, schema)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that are kept, with all their columns."""
    return filter_pass(docs, text_col, lambda texts: measure(texts)["kept"])

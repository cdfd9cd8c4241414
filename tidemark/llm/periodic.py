"""Runs of periodic words: stretches that repeat a shorter stretch at least four times over.

Every document gets an enhanced suffix array over its words: ranks of stretches of 1, 2, 4, ... words by doubling, and
the common prefixes of neighbours in suffix order. A square (a stretch twice in a row) whose next word breaks the period
is made of two suffixes whose common prefix is exactly one period long, so both lie in one interval of the common-prefix
array with that value, in different children. For every interval the suffixes of all children but the largest are
asked whether the suffix one period later, or earlier, lies in the interval too (n log n questions in all, intervals
being pairs of array places; no tree is built). Squares are rotated to the left as far as the words allow, and those of
one stretch merge into the run with the least period.

A slice of many documents is worked on at once: words of different documents count as different, so no match crosses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C

#: A run has at least this many words, and this many periods.
LEAST = 6
REPEATS = 4
BLANKS = [0x20, *range(0x09, 0x0E)]
WORD_BREAK = r"[\x20\x09-\x0D]+"


def split_words(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end) of the words in the flat bytes of the texts, and the first word of each text (and the end)."""
    table = np.zeros(256, bool)
    table[BLANKS] = True
    word = ~table[flat]
    before = np.concatenate([[False], word])[: len(word)]
    before[bounds[:-1][bounds[:-1] < len(word)]] = False
    begin = np.flatnonzero(word & ~before)
    after = np.concatenate([word, [False]])[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    after[last[last >= 0]] = False
    end = np.flatnonzero(word & ~after) + 1
    return begin, end, np.searchsorted(begin, bounds)


def gathered(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of the stretches end to end."""
    offsets = np.cumsum(sizes) - sizes
    return flat[np.repeat(begin - offsets, sizes) + np.arange(int(sizes.sum()))]


def word_numbers(flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same number for equal words."""
    sizes = end - begin
    data = gathered(flat, begin, sizes)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


class SuffixArray:
    """Suffixes of many word sequences in one array; each sequence ends in a mark of its own.

    ``levels[k][i]`` is the rank of the 2**k words from i on, equal for equal stretches only.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.order = np.argsort(symbols)
        head, places = _heads(symbols[self.order], np.arange(n))
        rank = np.empty(n, np.int32)
        rank[self.order] = head
        self.levels = [rank]
        step, head = 1, head[places]
        while len(places):
            some = self.order[places]
            # the marks differ, so a stretch that occurs twice ends before a mark
            key = head.astype(np.int64) * n + rank[some + step]
            by = np.argsort(key)
            some = some[by]
            self.order[places] = some
            head, open_ = _heads(key[by], places)
            rank = rank.copy()
            rank[some] = head
            self.levels.append(rank)
            step, places, head = 2 * step, places[open_], head[open_]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes from a and from b have in common at their beginnings (a and b differ)."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            same = self.levels[k][a + out] == self.levels[k][b + out]
            out += same.astype(np.int64) << k
        return out

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words in common just before a and b."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a - out - (1 << k), b - out - (1 << k)
            inside = np.flatnonzero((x >= 0) & (y >= 0))
            same = self.levels[k][x[inside]] == self.levels[k][y[inside]]
            out[inside] += same.astype(np.int64) << k
        return out


def _heads(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys at these places: the place of the first of equal ones, and which keys have an equal."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    head = places[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))].astype(np.int32)
    alone = first & np.append(first[1:], True)
    return head, np.flatnonzero(~alone)


def nearest_smaller(values: np.ndarray, equal: bool, right: bool) -> np.ndarray:
    """The nearest place on one side with a smaller value (or one as small, if ``equal``); -1 or the length where there is none.

    Minima over windows of 1, 2, 4, ... places are searched from the widest down.
    """
    n = len(values)
    if right:
        return n - 1 - nearest_smaller(values[::-1], equal, False)[::-1]
    tables = [values]
    while 1 << len(tables) <= n:
        low, half = tables[-1], 1 << (len(tables) - 1)
        wide = low.copy()
        wide[half:] = np.minimum(low[half:], low[:-half])
        tables.append(wide)
    at = np.arange(n) - 1
    limit = values if equal else values - 1
    for k in range(len(tables) - 1, -1, -1):
        here = np.flatnonzero(at >= (1 << k) - 1)
        above = tables[k][at[here]] > limit[here]
        at[here] -= above.astype(np.int64) << k
    return at


def squares(s: SuffixArray, least: int = REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of squares whose next word breaks the period, among those that can end a run of ``least`` periods.

    The period of a square need not be its least one.
    """
    n = len(s.order)
    none = np.zeros(0, np.int64)
    shared = s.ahead(s.order[:-1].astype(np.int64), s.order[1:].astype(np.int64)) if n > 1 else none
    lcp = np.concatenate([[0], shared, [0]]).astype(np.int32)
    at = np.flatnonzero(lcp > 0)
    if not len(at):
        return none, none
    # No interval reaches across a 0, so of each stretch of zeros the first and the last are enough.
    places = np.unique(np.concatenate([at - 1, at, at + 1]))
    values = lcp[places]
    left, right = places[nearest_smaller(values, False, False)], places[np.minimum(nearest_smaller(values, False, True), len(places) - 1)]
    child_end = places[np.minimum(nearest_smaller(values, True, True), len(places) - 1)]
    inner = values > 0
    # a boundary opens a child that ends before the next boundary of its interval or the interval's end
    low, high, value, begin, end = left[inner], right[inner] - 1, values[inner], places[inner], child_end[inner] - 1
    by = np.lexsort((begin, high, low))
    low, high, value, begin, end = (x[by] for x in (low, high, value, begin, end))
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    head = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    # the first child of each interval lies before its first boundary
    low, high, value, group = (np.concatenate([x, x[head]]) for x in (low, high, value, group))
    end = np.concatenate([end, begin[head] - 1])
    begin = np.concatenate([begin, low[len(begin) :]])
    sizes = end - begin + 1
    by = np.lexsort((sizes, group))
    largest = by[np.append(np.flatnonzero(np.diff(group[by])), len(by) - 1)]
    small = np.ones(len(group), bool)
    small[largest] = False
    low, high, value, begin, sizes = (x[small] for x in (low, high, value, begin, sizes))
    found = [(none, none)]
    inverse = np.empty(n, np.int64)
    inverse[s.order] = np.arange(n)
    for lo, hi, d, b, m in _portions(low, high, value, begin, sizes):
        suffix = s.order[np.repeat(b - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))].astype(np.int64)
        lo, hi, d = np.repeat(lo, m), np.repeat(hi, m), np.repeat(d, m)
        for first in (suffix, suffix - d):
            second = first + d
            other = second if first is suffix else first
            ok = np.flatnonzero((first - (least - 2) * d >= 0) & (second < n))
            where = inverse[other[ok]]
            ok = ok[(where >= lo[ok]) & (where <= hi[ok])]
            # the interval's value is the common prefix of its suffixes in different children
            ok = ok[s.ahead(first[ok], second[ok]) == d[ok]]
            a = first[ok] - (least - 2) * d[ok]
            ok = ok[s.ahead(a, a + d[ok]) >= (least - 1) * d[ok]]
            found.append((first[ok], d[ok]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


#: Suffixes asked at a time.
PORTION = 1 << 20


def _portions(*columns: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Children in portions of about ``PORTION`` suffixes; the last column is their sizes."""
    cuts = np.flatnonzero(np.diff(np.cumsum(columns[-1]) // PORTION)) + 1
    yield from zip(*(np.split(c, cuts) for c in columns), strict=True)


def runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs, in order of start and period; ``symbols`` are words and the marks after each text."""
    s = SuffixArray(symbols)
    place, period = squares(s)
    start = place - s.behind(place, place + period)
    end = place + 2 * period
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, length, period = start[first], (end - start)[first], period[first]
    long_ = length >= np.maximum(LEAST, REPEATS * period)
    start, length, period = start[long_], length[long_], period[long_]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _slice(texts: pa.Array) -> list[pa.Array]:
    """n_words, runs and collapsed text of each text of a slice."""
    flat, bounds = C.flat_bytes(texts)
    begin, end, first = split_words(flat, bounds)
    counts = np.diff(first)
    docs = np.arange(len(counts))
    number = word_numbers(flat, begin, end)
    # every text's words, then its mark; words of one text have numbers of their own
    symbols = np.empty(len(begin) + len(docs), np.int64)
    of = np.repeat(docs, counts)
    places = np.arange(len(begin)) + of
    width = int(number.max(initial=0)) + 2
    symbols[places] = of * width + number + 1
    symbols[first[1:] + docs] = docs * width
    start, length, period = runs(symbols)
    doc = np.searchsorted(first[:-1] + docs, start, side="right") - 1
    start = start - doc  # as words of the slice
    gone = np.zeros(len(begin) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    kept = np.cumsum(gone)[:-1] == 0
    per_doc = np.bincount(doc, minlength=len(docs))
    ints = lambda x: pa.array(x, pa.int64())
    found = pa.StructArray.from_arrays([ints(start - first[doc]), ints(length), ints(period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32()), found)
    return [ints(counts), lists, _joined(flat, begin[kept], end[kept], np.bincount(of[kept], minlength=len(docs)))]


def _joined(flat: np.ndarray, begin: np.ndarray, end: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The words of each text, joined by one space."""
    sizes = end - begin + 1
    ends = np.cumsum(sizes)
    out = np.full(int(sizes.sum()), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = gathered(flat, begin, sizes - 1)
    last = np.cumsum(counts)
    drop = ends[last[counts > 0] - 1] - 1  # the space after a text's last word
    offsets = np.concatenate([[0], np.concatenate([[0], ends])[last]])
    offsets = offsets - np.concatenate([[0], np.cumsum(counts > 0)])
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.delete(out, drop))]).cast(pa.large_string()).cast(pa.string())


_FOUND = "n_words long, runs array<struct<start:long, length:long, period:long>>, collapsed_text string"


def find_runs(docs: DataFrame) -> DataFrame:
    """All columns of the documents with ``n_words``, ``runs`` (by start, then period) and ``collapsed_text``.

    Words are stretches without blanks (space, tab to carriage return). A run is a stretch in which words one least period
    apart are equal and which no neighbouring word extends, of at least 6 words and 4 periods. The collapsed text has the
    words that no run holds after its first period, joined by one space. A null or empty text has no words, no run and
    an empty collapsed text; repeated rows get the same result; an empty table gives none. Columns with the results'
    names are replaced. A long text is handled whole, in memory that grows with its words.
    """
    found = T._parse_datatype_string(_FOUND).fields
    keep = C.without(docs, [f.name for f in found])
    src = docs.select(*map(C.quoted, keep), *([] if "text" in keep else [F.col("text")]))
    at = src.columns.index("text")
    names = [*src.columns, *[f.name for f in found]]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, *_slice(batch.column(at))], names)

    return C.mapped(src, C.over_slices(run, "text"), T.StructType([*src.schema.fields, *found]))


def with_planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents get the periodic stretch of the query in place of their later words."""
    x = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    hit = F.col("h") % 10 == 0
    x = x.select("doc_id", "text", F.expr("h div 10").alias("g"), F.when(hit, F.filter(F.split("text", WORD_BREAK), lambda w: w != "")).alias("words"))
    x = x.select("*", F.expr("CASE WHEN size(words) > 0 THEN cast(g % size(words) AS int) END").alias("a"))
    x = x.select("*", F.expr("1 + cast((size(words) - a) div (3 + g % 8) AS int)").alias("p"))
    changed = F.array_join(F.expr("transform(words, (w, i) -> CASE WHEN i < a THEN w ELSE words[a + (i - a) % p] END)"), " ")
    return x.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    found = find_runs(with_planted(docs))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    # doubles tell the quotients of numbers below 2**26 apart
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"] / r["period"]).alias("q"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    x = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
    return x.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

"""Problem 9: oversized items in pieces below a size limit, cut where the text has natural ends.

Method: agglomerative merging.  A text begins as atomic segments (its sentences; clauses, words or
single signs only where a sentence alone is too large).  Adjacent pairs wait in a heap and the pair
with the weakest boundary is merged first, while the combined size plus the overlap fits.  What is
left are pieces whose ends are the strongest boundaries of the text.  Every piece but the first begins
with the last ``overlap`` tokens of the text before it (up to three tokens more where that place would
lie inside a sign).

Sizes are tokens of a public tokenizer.  A text is encoded once, and the places where its tokens end
give the size of every stretch.  For byte-level BPE the segments end where the tokenizer's own split
ends, so sizes add up exactly; pieces of other tokenizers are counted again as far as the cut can change
them, and a piece that turned out too large is cut once more.  Texts within the limit, empty and null
texts give no rows.
"""

from __future__ import annotations

import heapq
import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lawweave.llm.bpe import BytePairs, vocabulary
from lawweave.llm.common import tokenizer_dir
from lawweave.llm.packing import limits
from lawweave.llm.sizes import counter, crossings, single_signs, token_ends

#: Tokens kept free besides the overlap: its place may have to move by a part of a sign.
SLACK = 3
#: Signs of texts that are measured together.  No result depends on it.
TOGETHER = 100_000
#: Tokens kept free for the mark some tokenizers set at a text's beginning.
MARK = 2
_HEADS = re.compile(r"[ \t　]*(?:第[一二三四五六七八九十百零〇0-9]{1,8}[章编节条]|Chapter\s|Article\s|CHAPTER\s|附件|附录)")
# Strength of the boundary after a sign.
STRENGTH = {c: 3 for c in "。！？!?…"} | {c: 2 for c in "；;：:"} | {c: 1 for c in "，,、 \t　"}


def strength(text: str, end: int) -> int:
    """How natural an end is: 6 before a chapter or article, 5 at a blank line, 4 at a line end, 3 at a sentence's, 2 and 1 at a clause's, 0 elsewhere."""
    if end >= len(text):
        return 7
    if text[end].isspace():
        return 0  # white space stays with what stands before it
    back = end
    while back > 0 and text[back - 1].isspace():
        back -= 1
    lines = text.count("\n", back, end)
    if lines:
        return 6 if _HEADS.match(text, end) else 5 if lines > 1 else 4
    if back < end and back and text[back - 1] in ".!?":
        return 3
    return STRENGTH.get(text[back - 1] if back else "", 1 if back < end else 0)


_ENDS = re.compile(r"(?:[。！？!?…]+[”’）》」』)\]]*|(?<=[a-z0-9)”])\.(?= )|\n)\s*")


_LINE_ENDS = re.compile(r"\n\s*")


def lines(text: str) -> list[tuple[int, int]]:
    """(end, strength) of the text's lines; the white space after a line end goes with it, but for a last space."""
    out = []
    n = len(text)
    for m in _LINE_ENDS.finditer(text):
        end = m.end()
        if end >= n:
            break
        space = text[end - 1] == " "
        out.append((end - space, 4 if space else strength(text, end)))
    if n:
        out.append((n, 7))
    return out


def sentences(text: str) -> list[tuple[int, int]]:
    """(end, strength) of the text's sentences and lines.

    An end is never between two punctuation signs, and a last space goes with the next sentence, so every end
    is an end of the byte-level tokenizers' own split as well.
    """
    out = []
    n = len(text)
    for m in _ENDS.finditer(text):
        end = m.end()
        if end >= n:
            break
        if text[end - 1] == " ":
            end -= 1
        before, after = text[end - 1], text[end]
        if end == m.start() or (not before.isspace() and not after.isspace() and not after.isalnum()):
            continue
        s = strength(text, end) if after != " " else 3 if not before.isspace() else 4
        if s >= 3:
            out.append((end, s))
    if n:
        out.append((n, 7))
    return out


class Ruler:
    """One text measured by one tokenizer: the places where its units end, and the tokens up to each of them.

    Units are the pieces of the tokenizer's own split (byte-level BPE) or its tokens (all others).  Every later
    question about sizes is a look-up here, so that a text is taken apart once for all limits.
    """

    def __init__(self, text: str, ends: np.ndarray, before: np.ndarray):
        self.text, self.ends, self.before = text, ends, before
        self.total = int(self.before[-1])
        self.places: list[int] = []
        self.sums: list[int] = []

    def listed(self) -> Ruler:
        """Ready for questions about single places, which lists answer faster."""
        self.places, self.sums = self.ends.tolist(), self.before.tolist()
        return self

    def upto(self, places: np.ndarray) -> np.ndarray:
        """Tokens that end at or before each place."""
        return self.before[self.ends.searchsorted(places, "right")]

    def at(self, place: int) -> int:
        """The same for one place."""
        return self.sums[bisect_right(self.places, place)]

    def units(self, a: int, b: int) -> list[tuple[int, int]]:
        """(end, tokens) of the units after ``a`` up to ``b``; units that end at one place are one."""
        lo, hi = np.searchsorted(self.ends, (a, b), "right")
        ends = self.ends[lo:hi]
        last = np.flatnonzero(np.append(ends[1:] != ends[:-1], True)) if len(ends) else np.zeros(0, np.int64)
        return list(zip(ends[last].tolist(), np.diff(self.before[lo + 1 + last], prepend=self.before[lo]).tolist(), strict=True))

    def long_unit(self, end: int, length: int, most: int) -> list[tuple[int, int, int]]:
        """A unit that is larger than ``most`` by itself, in parts."""
        return [(end, most, 0)]


class BpeRuler(Ruler):
    def __init__(self, v: BytePairs, text: str, measured: tuple[np.ndarray, ...] | None = None):
        ends, before, self.stretch_ends, self.stretch_before = measured or v.measure([text])[0]
        super().__init__(text, ends, before)
        self.v = v

    def listed(self) -> Ruler:
        self.stretch_places, self.stretch_sums = self.stretch_ends.tolist(), self.stretch_before.tolist()
        return super().listed()

    def long_unit(self, end: int, length: int, most: int) -> list[tuple[int, int, int]]:
        return _cut_long(self.v, self.text[end - length : end], end - length, most)

    def is_end(self, place: int) -> bool:
        k = bisect_left(self.places, place)
        return place == 0 or (k < len(self.places) and self.places[k] == place)

    def upto_stretch(self, place: int) -> int | None:
        """Tokens up to a place inside a unit that no token reaches over, beside which the text is split alike if it is cut there."""
        k = bisect_left(self.stretch_places, place)
        if self.stretch_places[k] != place or "'" in self.text[max(0, place - 2) : place + 1] or self.text[place - 1].isspace():
            return None
        return self.stretch_sums[k + 1]

    def size(self, start: int, end: int) -> int:
        """Tokens of ``text[start:end]`` as a text of its own (at most those it has inside the whole text)."""
        if self.is_end(start) and self.is_end(end):
            return self.at(end) - self.at(start)
        if (b := self.upto_stretch(end)) is not None and (a := self.at(start) if self.is_end(start) else self.upto_stretch(start)) is not None:
            return b - a
        return len(self.v.encode_packed(self.text[start:end])) // 4

    def overlap(self, core: int, wanted: int) -> tuple[int, int]:
        """(place, tokens): the latest sign's beginning with at least ``wanted`` tokens up to ``core``, and their number as a text of their own."""
        here = self.at(core) if self.is_end(core) else self.upto_stretch(core)
        if here is None:
            return self._search(core, wanted)
        if here <= wanted:
            return 0, here
        places, sums = self.stretch_places, self.stretch_sums
        k = bisect_right(sums, here - wanted) - 1
        at = places[k - 1] if k else 0
        if sums[k] == here - wanted:  # no token reaches over this place
            return at, wanted
        raw = self.text[at : places[k]].encode("utf-8", "replace")
        need = sums[k + 1] - here + wanted
        cut = len(raw) - sum(self.v.last_tokens(raw, need)[-need:])
        while cut and raw[cut] & 0xC0 == 0x80:
            cut -= 1
        if not cut:
            return at, here - sums[k]
        at += len(raw[:cut].decode("utf-8", "replace"))
        return at, here - sums[k + 1] + self.v.count_pieces([self.text[at : places[k]]])

    def _search(self, core: int, wanted: int) -> tuple[int, int]:
        """For a core that begins inside a unit: by halving, within a reach that is widened until it is enough."""
        def count(a: int) -> int:
            return len(self.v.encode_packed(self.text[a:core])) // 4

        reach = 2 * wanted + 16
        while reach < core and count(core - reach) <= wanted:
            reach *= 4
        lo, hi = max(0, core - reach), core
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if count(mid) >= wanted else (lo, mid)
        return lo, count(lo)


class TokenRuler(Ruler):
    """For tokenizers whose pieces by themselves may have other tokens than inside the text: those are counted again."""

    def __init__(self, name: str, folder: str | None, text: str):
        ends = token_ends(name, folder)(text)
        super().__init__(text, ends, np.arange(len(ends) + 1))
        self.count, self.crossed = counter(name, folder), crossings(name, folder)

    def _apart(self, place: int) -> bool:
        """Whether no token can reach over a place."""
        return place >= len(self.text) or self.text[place - 1 : place + 1].replace(" ", "▁") not in self.crossed

    def size(self, start: int, end: int) -> int:
        if self.crossed is None or not self._apart(end):
            return self.count(self.text[start:end])
        if not start:
            return self.at(end)
        k = bisect_right(self.places, start)
        for place in self.places[k : k + 64]:
            if place >= end:
                break
            if self._apart(place):  # only what stands before this place can change by the cut
                return self.count(self.text[start:place]) + self.at(end) - self.at(place)
        return self.count(self.text[start:end])

    def overlap(self, core: int, wanted: int) -> tuple[int, int]:
        here = self.at(core)
        j = here - wanted
        while j > 0 and self.at(self.places[j - 1]) > here - wanted:
            j -= 1
        place = self.places[j - 1] if j > 0 else 0
        return place, self.count(self.text[place:core])


def _segments(ruler: Ruler, ends: list[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """(end, size, strength) of the atomic segments: lines; the sentences of a line that is too large; their clauses, words or signs."""
    out: list[tuple[int, int, int]] = []
    text, at = ruler.text, 0
    sizes = np.diff(ruler.upto(np.fromiter((e for e, _ in ends), np.int64, len(ends))), prepend=0).tolist()
    for (end, s), n in zip(ends, sizes, strict=True):
        if n <= most:
            out.append((end, n, s))
        else:
            inner = [(at + e, s if at + e == end else t) for e, t in sentences(text[at:end])]
            start = at
            for (stop, t), k in zip(inner, np.diff(ruler.upto(np.array([at, *(e for e, _ in inner)]))).tolist(), strict=True):
                out += [(stop, k, t)] if k <= most else _parts(ruler, start, stop, t, most)
                start = stop
        at = end
    return out


def gathered(segments: list[tuple[int, int, int]], most: int) -> list[tuple[int, int, int]]:
    """Segments joined where the order of merging cannot matter: level by level, runs that fit as a whole.

    Boundaries are merged weakest first, so a run between two stronger boundaries that fits is always merged
    completely before either of them comes up; the heap only has to see what is left.
    """
    for level in (4, 5, 6, 7):
        out: list[tuple[int, int, int]] = []
        run: list[tuple[int, int, int]] = []
        size = 0
        for x in segments:
            run.append(x)
            size += x[1]
            if x[2] >= level:
                out += run if len(run) == 1 or size > most else [(x[0], size, x[2])]
                run, size = [], 0
        segments = out + run
    return segments


def _parts(ruler: Ruler, start: int, stop: int, s_last: int, most: int) -> list[tuple[int, int, int]]:
    """A sentence that is too large by itself: its clauses, words, or stretches of signs."""
    out: list[tuple[int, int, int]] = []
    inner: list[tuple[int, int, int]] = []
    text, before = ruler.text, start
    units = ruler.units(start, stop)
    if not units or units[-1][0] != stop:
        units.append((stop, 0))
    for at, n in units:
        if n > most:
            out += (_merge_weak(inner, most) if inner else []) + ruler.long_unit(at, at - before, most)
            inner = []
        else:
            last = text[at - 1]
            inner.append((at, n, s_last if at == stop else strength(text, at) if last in STRENGTH or last.isspace() or last == "." else 0))
        before = at
    return out + (_merge_weak(inner, most) if inner else [])


def _merge_weak(inner: list[tuple[int, int, int]], most: int, level: int = 2) -> list[tuple[int, int, int]]:
    """Units of a sentence that is too large, joined into its clauses; into words where a clause alone is too large.

    Where there is no boundary at all, units are joined up to a quarter of the limit, so that the heap sees few of them.
    """
    out: list[tuple[int, int, int]] = []
    run: list[tuple[int, int, int]] = []
    size = 0
    for k, x in enumerate(inner):
        run.append(x)
        size += x[1]
        if k + 1 == len(inner) or (x[2] >= level if level else size + inner[k + 1][1] > most // 4):
            out += [(x[0], size, x[2])] if size <= most else _merge_weak(run, most, level - 1) if level else run
            run, size = [], 0
    return out


def _cut_long(v: BytePairs, piece: str, start: int, most: int) -> list[tuple[int, int, int]]:
    """A stretch without any split of the tokenizer: cut between signs that no token spans, else before any sign."""
    out, at = [], 0
    _, _, ends, before = v.measure([piece])[0]
    safe, sums = ends.tolist(), before.tolist()
    while at < len(piece):
        end = min(len(piece), at + most)
        k = bisect_right(safe, end) - 1
        end = safe[k] if k >= 0 and safe[k] > at else end
        while (n := _tokens(v, piece, at, end, safe, sums)) > most:
            shorter = at + max(1, (end - at) * most // n - 1)
            k = bisect_right(safe, shorter) - 1
            end = safe[k] if k >= 0 and safe[k] > at else shorter
            if end - at <= 1:
                n = len(v.encode_packed(piece[at:end])) // 4
                break
        out.append((start + end, n, 0))
        at = end
    return out


def _tokens(v: BytePairs, piece: str, at: int, end: int, safe: list[int], sums: list[int]) -> int:
    """Tokens of ``piece[at:end]``, added up where no token reaches over its ends."""
    j, k = bisect_right(safe, at), bisect_right(safe, end)
    if (at and safe[j - 1] != at) or not k or safe[k - 1] != end or "'" in piece[max(0, at - 2) : end]:
        return len(v.encode_packed(piece[at:end])) // 4
    return sums[k] - sums[j]


def merge(segments: list[tuple[int, int, int]], most: int) -> list[int]:
    """Ends of the pieces: adjacent segments merged up to ``most``, weakest boundary first, smallest sum first among equals."""
    segments = gathered(segments, most)
    n = len(segments)
    size = [s for _, s, _ in segments]
    last = list(range(n))  # index of the last segment of the group that begins here
    first = list(range(n))  # the first of the group that ends here
    heap = [(segments[i][2], size[i] + size[i + 1], i, i + 1) for i in range(n - 1) if size[i] + size[i + 1] <= most]
    heapq.heapify(heap)
    gone = [False] * n
    while heap:
        s, total, a, b = heapq.heappop(heap)
        if gone[a] or gone[b] or size[a] + size[b] != total or last[a] + 1 != b:  # stale
            continue
        gone[b] = True
        size[a] = total
        last[a] = last[b]
        first[last[b]] = a
        nxt = last[a] + 1
        if nxt < n and total + size[nxt] <= most:
            heapq.heappush(heap, (segments[last[a]][2], total + size[nxt], a, nxt))
        if a > 0 and size[p := first[a - 1]] + total <= most:
            heapq.heappush(heap, (segments[a - 1][2], size[p] + total, p, a))
    return [segments[last[i]][0] for i in range(n) if not gone[i]]


def split(text: str, tokenizer: str, capacity: int, overlap: int, folder: str | None = None) -> list[tuple[int, int, int, int]]:
    """(start, core_start, end, size) of the pieces of one text; none if the text is within the limit.

    ``text[start:end]`` is the piece, ``text[start:core_start]`` its overlap with the piece before.
    """
    return split_all(text, tokenizer, [(capacity, overlap)], folder)[0]


@lru_cache(maxsize=None)
def byte_level(tokenizer: str, folder: str | None = None) -> bool:
    return os.path.exists(os.path.join(tokenizer_dir(folder), f"{tokenizer}.tiktoken"))


def fits(text: str, tokenizer: str, least: int, folder: str | None = None) -> bool:
    """Whether a text is within ``least`` tokens for sure, by its signs alone."""
    if len(text) * (1 if text.isascii() else 4) + MARK <= least:  # a byte has at most one token
        return True
    return len(text) + MARK <= least and bool(known := single_signs(tokenizer, folder)) and len(text) + 3 * sum(map(text.count, set(text) - known)) + MARK <= least


def rulers(texts: list[str | None], tokenizer: str, least: int, folder: str | None = None) -> Iterator[Ruler | None]:
    """The ruler of each text, None where it ``fits``; with byte-level BPE many texts are measured in one pass."""
    todo = [t if t and not fits(t, tokenizer, least, folder) else None for t in texts]
    if not byte_level(tokenizer, folder):
        yield from (t and TokenRuler(tokenizer, folder, t) for t in todo)
        return
    v, at = vocabulary(tokenizer, folder), 0
    while at < len(todo):
        end, signs = at, 0
        while end < len(todo) and signs < TOGETHER:
            signs += len(todo[end] or "")
            end += 1
        measured = iter(v.measure([t for t in todo[at:end] if t]))
        yield from (t and BpeRuler(v, t, next(measured)) for t in todo[at:end])
        at = end


def split_all(text: str, tokenizer: str, todo: list[tuple[int, int]], folder: str | None = None) -> list[list[tuple[int, int, int, int]]]:
    """``split`` for several (capacity, overlap) of one tokenizer: the text is cut into segments and counted once."""
    return split_measured(next(rulers([text], tokenizer, min(c for c, _ in todo), folder)), todo)


def split_measured(r: Ruler | None, todo: list[tuple[int, int]], ends: list[tuple[int, int]] | None = None) -> list[list[tuple[int, int, int, int]]]:
    """The same for a text that is measured.  ``ends``: its ``lines``, where the caller has them."""
    room = [c - (o + SLACK if o else 0) - MARK for c, o in todo]
    if min(room) < 1:
        raise ValueError("the overlap leaves no room in a piece")
    least = min(c for c, _ in todo)
    if r is None or r.total <= least:
        return [[] for _ in todo]
    segments = _segments(r.listed(), lines(r.text) if ends is None else ends, min(room))
    result = []
    for (capacity, overlap), most in zip(todo, room, strict=True):
        out: list[tuple[int, int, int, int]] = []
        core = 0
        for end in merge(segments, most) if r.total > capacity else ():
            out += _checked(r, core, end, capacity, overlap, bool(out))
            core = end
        result.append(out)
    return result


def _checked(r: Ruler, core: int, end: int, capacity: int, overlap: int, later: bool) -> list[tuple[int, int, int, int]]:
    """The piece with its overlap; two or more where it is too large by itself after all."""
    start, extra = r.overlap(core, overlap) if overlap and later else (core, 0)
    # With byte-level BPE the core begins where the tokenizer's own split does, so the two sizes add up.
    whole = r.size(core, end) + extra if isinstance(r, BpeRuler) and r.is_end(core) else r.size(start, end)
    if whole <= capacity or end - core <= 1:
        return [(start, core, end, whole)]
    middle = (core + end) // 2
    cut = max(range(core + 1, end), key=lambda i: (strength(r.text, i), -abs(i - middle)))
    return _checked(r, core, cut, capacity, overlap, later) + _checked(r, cut, end, capacity, overlap, True)


def split_documents(docs: DataFrame, id: str, text: str, size_limits: DataFrame, folder: str | None = None) -> DataFrame:
    """(limit_id, id, piece, start, core_start, end, tokens, text) of every document above a piece limit.

    ``tokens`` is the size as it adds up inside the whole text; the piece by itself never has more.  Narrow: each text is cut in the task that reads it.
    """
    todo = limits(size_limits, "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            found = {}
            ends = [lines(t) if t else [] for t in texts]
            for tokenizer in dict.fromkeys(t for _, t, _, _ in todo):
                mine = [(limit, c, o) for limit, t, c, o in todo if t == tokenizer]
                cut = [split_measured(r, [x[1:] for x in mine], e) for r, e in zip(rulers(texts, tokenizer, min(c for _, c, _ in mine), folder), ends, strict=True)]
                found |= {limit: [c[k] for c in cut] for k, (limit, _, _) in enumerate(mine)}
            for limit, *_ in todo:
                rows = [(i, k, *p) for i, cut in enumerate(found[limit]) for k, p in enumerate(cut)]
                ids = b.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                ints = [pa.array([r[k] for r in rows], pa.int32()) for k in (1, 2, 3, 4, 5)]
                pieces = pa.array([texts[r[0]][r[2] : r[4]] for r in rows], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([limit] * len(rows), pa.int32()), ids, *ints, pieces], names=["limit_id", id, "piece", "start", "core_start", "end", "tokens", text])

    whole = [StructField(c, IntegerType()) for c in ("piece", "start", "core_start", "end", "tokens")]
    schema = StructType([StructField("limit_id", IntegerType()), docs.schema[id], *whole, StructField(text, StringType())])
    return docs.where(F.col(text) != "").select(id, text).mapInArrow(run, schema)

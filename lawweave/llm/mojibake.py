"""Problem 2: text that was read in a wrong character encoding.

Method: a hidden Markov model labels the characters of a text.  One state is clean text, one state
stands for every pair (true encoding, encoding it was read in), one for bytes already replaced by a
substitute.  The likeliest path finds the garbled spans; a span's state is then the pair under which the
whole span is likeliest, a garbled sign being as likely as the clean signs it stands for.  Each labelled
span goes through its state's inverse transform and no other (encode in the wrong encoding, decode in the
true one); the exact check keeps a span only if its bytes decode to signs of clean text.

Nothing is fitted on a sample.  The clean state's frequencies and the signs of clean text are counted
over all rows, and a pair's frequencies are those of all rows after the wrong reading.  Rows that the
first fit finds garbled leave all counts of the second fit, and the spans found in them give the
probability of entering one.  All rows are labelled and restored, whole.  Signs in no stretch that could gain, in any
other state, what entering and leaving that state costs are clean on the best path, and the search skips them.

Null texts stay null, empty ones empty; neither is ever affected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from lawweave.session import cut

#: Texts that a task misreads together.  No result depends on it.
TOGETHER = 1_000
#: Log-probability of entering a garbled span before any was seen, and for how many signs it stands.
ENTER, PRIOR_SIGNS = -6.9, 1_000_000
#: What entering a span is made cheaper by than was fitted: a span too many is dropped by the exact check, one too few is lost.
LENIENT = 0.6
#: Log-probability of leaving one.  It is not fitted: ASCII is alike in all states, so the length of the spans says too
#: little, and with a rarer leaving neighbouring spans run together over the ASCII between them.
LEAVE = -3.0
STAY = float(np.log1p(-np.exp(LEAVE)))
#: Share of a restored span's signs beyond ASCII that must be usual in clean text.
USUAL = 0.6
#: Name of UTF-8 that was read wrongly, written again as UTF-8 and read wrongly once more.
TWICE = "utf-8 twice"
# Fixed values: (true encoding, encoding it was read in).
PAIRS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "gb18030"), ("utf-8", "gbk"), ("utf-8", "cp932"), ("utf-8", "big5"), ("utf-8", "cp1251"), ("utf-8", "koi8_r"), ("gb18030", "cp1252"), ("gb18030", "latin-1"), ("gb18030", "big5"), ("gb18030", "cp932"), ("big5", "gbk"), ("big5", "cp1252"), ("cp1252", "gbk"), (TWICE, "cp1252"), (TWICE, "latin-1")]
#: Encodings of more than one byte a sign, and for how many signs each has room.  Read in any other, a sign comes out alike beside any neighbour.
WIDE = {"gb18030": 24_000, "gbk": 22_000, "big5": 14_000, "cp932": 8_000}
#: What is left of bytes that no decoder knew: the substitute sign, and its own bytes read as GBK.
LOST = "�锟斤拷"
_QUOTED = [("“", "”"), ("‘", "’"), ('"', '"'), ("「", "」"), ("『", "』"), ("《", "》"), ("'", "'")]


def _web1252() -> tuple[dict[int, str], dict[str, int]]:
    """Windows-1252 with the five free bytes read as control signs, as browsers read it."""
    there = {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(256)}
    return there, {c: b for b, c in there.items()}


_TO1252, _FROM1252 = _web1252()


def misread(text: str, true: str, wrong: str) -> str:
    """``text`` written in ``true`` and read in ``wrong``; unreadable bytes become substitutes."""
    if true == TWICE:
        return misread(misread(text, "utf-8", wrong), "utf-8", wrong)
    b = text.encode(true, "ignore")
    return "".join(map(_TO1252.__getitem__, b)) if wrong == "cp1252" else b.decode(wrong, "replace")


def reread(text: str, true: str, wrong: str) -> str:
    """The inverse of ``misread``; what the bytes no longer allow comes out as substitutes."""
    if true == TWICE:
        return reread(reread(text, "utf-8", wrong), "utf-8", wrong)
    return b"".join(map(_bytes_of(wrong).__getitem__, text)).decode(true, "replace")


class _Bytes(dict):
    """The bytes of every sign in an encoding, as they are asked for; signs it can't write are one byte that stands for none."""

    def __init__(self, wrong: str):
        self.wrong = wrong

    def __missing__(self, c: str) -> bytes:
        try:
            b = c.encode(self.wrong) if self.wrong != "cp1252" else bytes([_FROM1252[c]])
        except (UnicodeEncodeError, KeyError):
            b = b"\xff"
        self[c] = b
        return b


@lru_cache(maxsize=None)
def _bytes_of(wrong: str) -> _Bytes:
    return _Bytes(wrong)


@dataclass
class Model:
    """Log-probabilities of signs by state (0 is clean), and the signs usual in clean text."""

    signs: np.ndarray  # sorted code points
    logp: np.ndarray  # (signs + 1) x states; the last row is for signs not in the table
    usual: frozenset[str]
    pairs: list[tuple[str, str]] = field(default_factory=lambda: PAIRS)
    enter: float = ENTER

    def __post_init__(self) -> None:
        self.gain = (self.logp[:, 1:] - self.logp[:, :1]).max(1)  # what the best other state gains or loses on a sign
        self.row = np.full(0x110000, len(self.signs), np.int32)
        self.row[self.signs] = np.arange(len(self.signs))
        # Clean text by sign: signs that none held share a rest by their script, so a rare sign of a small script is likelier.
        self.clean = np.full(0x110000, np.log(2.5e-4 / 30_000))
        for first, last, size in ((0, 0x250, 400), (0x2000, 0x2C00, 3_000), (0x3400, 0xA000, 28_000)):
            self.clean[first:last] = np.log(2.5e-4 / size)
        self.clean[self.signs] = np.maximum(self.clean[self.signs], self.logp[:-1, 0])
        self.clean[0xFFFD] = -27.0

    def __getstate__(self) -> tuple:
        return self.signs, self.logp, self.usual, self.pairs, self.enter

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def doubtful(self, texts: list[str]) -> list[int]:
        """Texts that may have a better path than the all-clean one.

        Entering a garbled span costs ``enter``; where no stretch of the text gains as much, even if each
        sign took its best state, the all-clean path is the best one.
        """
        some = [i for i, t in enumerate(texts) if t and not t.isascii()]
        if not some:
            return []
        o = np.frombuffer("\0".join([texts[i] for i in some] + [""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(texts[i]) + 1 for i in some])
        gain = self.gain[self.row[o]]
        gain[ends - 1] = -1e5  # no stretch reaches over the end of a text
        total = np.cumsum(gain)
        best = np.maximum.reduceat(total - np.minimum.accumulate(np.concatenate([[0.0], total[:-1]])), np.concatenate([[0], ends[:-1]]))
        return [i for i, g in zip(some, best, strict=True) if g >= -self.enter]


def usual_signs(clean: Counter) -> frozenset[str]:
    """Signs beyond ASCII that are usual, by the counts of clean text."""
    least = max(2, 2e-6 * sum(clean.values()))
    return frozenset(c for c, n in clean.items() if n > least and ord(c) > 127)


def wide_pairs(pairs: list[tuple[str, str]]) -> list[int]:
    """The pairs whose wrong reading joins bytes of neighbouring signs, so that texts have to be misread to count its signs."""
    return [k for k, (_, wrong) in enumerate(pairs) if wrong in WIDE]


def misread_counts(texts: list[str], usual: frozenset[str], pairs: list[tuple[str, str]], total: dict[int, np.ndarray], times: int = 1) -> None:
    """Adds to ``total``, so many ``times``, how often each sign stands in the texts' usual signs and ASCII after each wide pair's wrong reading."""
    if not texts:
        return
    keep = np.zeros(0x110000, bool)
    keep[[*range(128), *map(ord, usual)]] = True
    end = "\n\n\n"  # a sign of GB 18030 has up to four bytes: begun ones are read alike after each text
    signs = np.frombuffer("\n".join([*texts, end]).encode("utf-32-le", "surrogatepass"), np.uint32)
    good = signs[keep[signs]].tobytes().decode("utf-32-le")  # a line end is never the second half of a sign: texts stay apart
    for k in wide_pairs(pairs):
        n = np.bincount(np.frombuffer(misread(good, *pairs[k]).encode("utf-32-le"), np.uint32))
        n[10] -= len(texts) + len(end)
        total.setdefault(k, np.zeros(0x110000, np.int64))[: len(n)] += times * n


def fit(texts: list[str], pairs: list[tuple[str, str]] = PAIRS) -> Model:
    """Sign frequencies of each state from texts that are taken as clean."""
    clean, total = without_lost(Counter("".join(texts))), {}
    misread_counts(texts, usual_signs(clean), pairs, total)
    return fit_counts(clean, {k: as_counter(n) for k, n in total.items()}, pairs)


def as_counter(n: np.ndarray) -> Counter:
    seen = np.flatnonzero(n)
    return Counter(dict(zip(map(chr, seen.tolist()), n[seen].tolist(), strict=True)))


def without_lost(counts: Counter) -> Counter:
    """Counts of the signs that clean text can have."""
    return Counter({c: n for c, n in counts.items() if c not in LOST and n > 0})


def fit_counts(clean: Counter, wide: dict[int, Counter], pairs: list[tuple[str, str]] = PAIRS) -> Model:
    """The model from counts: of the signs of clean text, and of the signs after the wrong reading of each of the ``wide_pairs``.

    For all other pairs a sign's wrong reading does not depend on its neighbours, so the first counts are enough.
    """
    usual = usual_signs(clean)
    states = [clean]
    for k, pair in enumerate(pairs):
        states.append(Counter(wide.get(k)))
        if pair[1] not in WIDE:
            for c, n in clean.items():
                for x in misread(c, *pair) if c in usual or ord(c) < 128 else "":
                    states[-1][x] += n
    states.append(Counter({"�": 30, "锟": 25, "斤": 25, "拷": 25}))
    # Signs a state can have at all: those of its codec; the smoothing mass is spread over them.
    room = [60_000] + [WIDE.get(w, 256) for _, w in pairs] + [8]
    halves = {ord(misread(chr(b), "latin-1", w)) for _, w in pairs if w in ("cp1252", "latin-1", "mac_roman", "cp1251", "koi8_r") for b in range(128, 256)}
    signs = np.array(sorted({ord(c) for s in states for c in s} | halves), np.uint32)
    at = {int(o): i for i, o in enumerate(signs)}
    logp = np.full((len(signs) + 1, len(states)), -27.0)
    for k, (s, v) in enumerate(zip(states, room, strict=True)):
        n = sum(s.values()) or 1
        even = 1e-3 / v if k == 0 else 0.2 / v  # what is spread evenly over the signs the state can have
        logp[:, k] = np.log(even) if v > 1000 else -22.0
        if k and v == 256:
            for c in {misread(bytes([b]).decode("latin-1"), "latin-1", pairs[k - 1][1]) for b in range(128, 256)}:
                if ord(c) in at:
                    logp[at[ord(c)], k] = np.log(even)
        for c, m in s.items():
            logp[at[ord(c)], k] = np.log(0.8 * m / n + even)
    for o in range(128):  # ASCII is the same in every reading: it neither opens nor closes a span
        if o in at:
            logp[at[o], 1:] = np.minimum(logp[at[o], 1:], logp[at[o], 0])
    return Model(signs, logp, usual, pairs)


def _windows(model: Model, texts: list[str]) -> list[tuple[int, int, int]]:
    """(text, start, end) of the stretches that hold every garbled span of the texts' best paths.

    A span gains less than if each sign took its best state, pays for entering, staying and, but at the text's end,
    leaving, and is worth it only if something remains.  A sign in no stretch that could gain as much is clean.
    """
    o = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    marks = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    gain = model.gain[model.row[o]] + STAY
    gain[marks[marks > 0] - 1] -= LEAVE
    gain[marks] = -1e5
    total = np.cumsum(gain)
    upto = total - np.minimum.accumulate(np.append(0.0, total[:-1]))  # the most that a stretch ending with each sign gains
    after = np.maximum.accumulate(total[::-1])[::-1] - total  # and one after it
    near = upto + after >= STAY - LEAVE - model.enter - 1e-3  # sums are rounded
    near[marks] = False
    edges = np.flatnonzero(np.diff(near, prepend=False, append=False)).reshape(-1, 2)
    which = marks.searchsorted(edges[:, 0])
    return list(zip(which.tolist(), *(edges - np.append(0, marks + 1)[which][:, None]).T.tolist(), strict=True)) if len(edges) else []


def label(model: Model, texts: list[str]) -> list[np.ndarray]:
    """The likeliest state of every sign (Viterbi), for many stretches of texts in step; all signs beside them are clean."""
    out = [np.zeros(len(t), np.int8) for t in texts]
    todo = sorted(_windows(model, [t or "" for t in texts]), key=lambda x: x[2] - x[1])
    k = model.logp.shape[1]
    at = 0
    while at < len(todo):
        longest = todo[min(at + 255, len(todo) - 1)]
        block = todo[at : at + max(1, min(256, 4_000_000 // ((longest[2] - longest[1]) * k)))]
        at += len(block)
        sizes = np.array([b - a for _, a, b in block])
        n, w = len(block), int(sizes[-1])
        codes = np.zeros((n, w), np.int64)
        for r, (i, a, b) in enumerate(block):
            codes[r, : b - a] = model.row[np.frombuffer(texts[i][a:b].encode("utf-32-le", "surrogatepass"), np.uint32)]
        first = sizes.searchsorted(np.arange(w), "right").tolist()  # the stretches that reach so far
        back = np.zeros((w, n, k), np.int8)  # for clean: the state before; for others: 1 = entered from clean
        v = np.full((n, k), model.enter)
        v[:, 0] = 0.0
        v += model.logp[codes[:, 0]]
        for t in range(1, w):
            lo = first[t]
            old = v[lo:]
            best = old[:, 1:].argmax(1) + 1
            leave = old[np.arange(n - lo), best] + LEAVE
            new = old + STAY
            clean = old[:, 0]
            go = leave > clean
            back[t, lo:, 0] = np.where(go, best, 0)
            new[:, 0] = np.where(go, leave, clean)
            come = (clean + model.enter)[:, None]
            back[t, lo:, 1:] = come > new[:, 1:]
            np.maximum(new[:, 1:], come, out=new[:, 1:])
            v[lo:] = new + model.logp[codes[lo:, t]]
        v[[b < len(texts[i]) for i, _, b in block], 1:] += LEAVE  # a clean sign follows
        state = v.argmax(1)
        paths = np.zeros((n, w), np.int8)
        for t in range(w - 1, -1, -1):
            lo = first[t]
            s = state[lo:]
            paths[lo:, t] = s
            b = back[t, np.arange(lo, n), s]
            state[lo:] = np.where(s == 0, b, np.where(b > 0, 0, s))
        for r, (i, a, b) in enumerate(block):
            out[i][a:b] = paths[r, : b - a]
    return out


def _spans(path: np.ndarray) -> list[tuple[int, int, int]]:
    edges = np.flatnonzero(np.diff(path)) + 1
    return [(int(a), int(b), int(path[a])) for a, b in zip([0, *edges], [*edges, len(path)], strict=True) if path[a]]


def _quoted(text: str, a: int, b: int) -> bool:
    """A short span that stands alone between quotation marks is quoted as an example."""
    while a < b and text[a] in "“‘\"「『《'":
        a += 1
    while a < b and text[b - 1] in "”’\"」』》'":
        b -= 1
    return b - a <= 12 and a > 0 and b < len(text) and (text[a - 1], text[b]) in _QUOTED


def usual_share(model: Model, text: str) -> float:
    """Of the signs beyond ASCII, the share that is usual in clean text."""
    far = [c for c in text if ord(c) > 127]
    return sum(c in model.usual for c in far) / len(far) if far else 0.0


def likeliest_pair(model: Model, text: str, a: int, b: int) -> int:
    """The state of the span ``text[a:b]`` as a whole: the pair under which its signs, and the clean text its inverse gives, are likeliest.

    Equal ones: the first.  Pairs come by the likelihood of the signs themselves, which bounds the whole, so most need no inverse.
    """
    seen = np.frombuffer(text[a:b].encode("utf-32-le", "surrogatepass"), np.uint32)
    emitted = model.logp[model.row[seen]].sum(0)[1:-1]

    def likelihood(k: int) -> float:
        best = -np.inf
        for end in _ends(text, b, model.pairs[k][0]):
            best = max(best, float(model.clean[np.frombuffer(reread(text[a:end], *model.pairs[k]).encode("utf-32-le", "surrogatepass"), np.uint32)].sum()))
        return best + float(emitted[k])

    top = (-np.inf, 0)
    for k in np.argsort(-emitted, kind="stable").tolist():
        if emitted[k] < top[0]:
            break
        top = max(top, (likelihood(k), -k))
    return 1 - top[1]


def _ends(text: str, b: int, true: str) -> tuple[int, ...]:
    """Where a span may end: the last sign's second byte may look like ASCII."""
    return (b, b + 1) if b < len(text) and ord(text[b]) < 128 and true != "utf-8" else (b,)


def restore(model: Model, text: str, path: np.ndarray) -> tuple[str, int]:
    """The text with every confirmed span inverted by its state, and the number of confirmed spans."""
    out, done, found = [], 0, 0
    for a, b, s in _spans(path):
        while a < b and ord(text[a]) < 128:
            a += 1
        while b > a and ord(text[b - 1]) < 128:
            b -= 1
        span = text[a:b]
        if not span or _quoted(text, a, b):
            continue
        if s == len(model.pairs) + 1:  # bytes already lost: found, but nothing to restore
            found += any(c in "�" for c in span) or "锟斤拷" in span
            continue
        true, wrong = model.pairs[likeliest_pair(model, text, a, b) - 1]
        best = (usual_share(model, span), 0, "", b)
        for end in _ends(text, b, true):
            again = reread(text[a:end], true, wrong)
            whole = "�" not in again
            share = 1.0 if whole and true == "utf-8" and len(again) < end - a and max(again) < "⻀" else usual_share(model, again)
            if true != "utf-8" and (b - a < 2 or (true == "cp1252" and not again.isalpha())):
                continue
            if share > best[0] + 1e-9 or (share == best[0] and whole > best[1]):
                best = (share, whole, again, end)
        if best[2] and best[0] >= USUAL:
            found += 1
            out += [text[done:a], best[2]]
            done = best[3]
        elif "�" in span or "锟斤拷" in span:
            found += 1
    return "".join([*out, text[done:]]), found


def repair(model: Model, texts: list[str | None]) -> list[tuple[str | None, int]]:
    """(restored text, confirmed spans) of each text; texts that cannot hold a garbled span pass at once."""
    out: list[tuple[str | None, int]] = [(t, 0) for t in texts]
    todo = model.doubtful(texts)
    for i, path in zip(todo, label(model, [texts[i] for i in todo]), strict=True):
        if path.any():
            out[i] = restore(model, texts[i], path)
    return out


def _counted(df: DataFrame, text: str, count: Callable[[list[str], dict[int, np.ndarray]], None]) -> dict[int, Counter]:
    """The counts of signs that ``count`` adds up over all rows, by key.

    Counted per task before the shuffle; the rows that come back are bounded by the signs of Unicode.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            count([t for t in b.column(0).to_pylist() if t], total)
        for k, n in total.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), k), pa.int64()), pa.array(seen, pa.int64()), pa.array(n[seen], pa.int64())], names=["k", "sign", "n"])

    rows = df.select(text).mapInArrow(run, StructType([StructField(c, LongType()) for c in ("k", "sign", "n")]))
    out: dict[int, Counter] = {}
    for k, sign, n in rows.groupBy("k", "sign").agg(F.sum("n")).collect():
        out.setdefault(k, Counter())[chr(sign)] = n
    return out


def sign_counts(df: DataFrame, text: str) -> Counter:
    """How often each sign stands in all rows."""

    def count(texts: list[str], total: dict[int, np.ndarray]) -> None:
        n = np.bincount(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32))
        total.setdefault(0, np.zeros(0x110000, np.int64))[: len(n)] += n

    return _counted(df, text, count).get(0, Counter())


def pair_counts(df: DataFrame, text: str, usual: frozenset[str], pairs: list[tuple[str, str]], together: int = TOGETHER) -> dict[int, Counter]:
    """How often each sign stands in all rows' usual signs after the wrong reading of each of the ``wide_pairs``."""

    def count(texts: list[str], total: dict[int, np.ndarray]) -> None:
        for at in range(0, len(texts), together):
            misread_counts(texts[at : at + together], usual, pairs, total)

    return _counted(df, text, count)


def pair_changes(df: DataFrame, text: str, before: frozenset[str], usual: frozenset[str], pairs: list[tuple[str, str]]) -> dict[int, Counter]:
    """What ``pair_counts`` change by if other signs are usual than ``before``: only rows with a sign of which that differs are misread.

    Such signs are about as frequent as the least usual ones, so few rows hold any.
    """
    differs = np.zeros(0x110000, bool)
    differs[list(map(ord, before ^ usual))] = True

    def count(texts: list[str], total: dict[int, np.ndarray]) -> None:
        ends = np.cumsum([len(t) for t in texts])
        hit = np.flatnonzero(differs[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)])
        mine = [texts[i] for i in np.unique(ends.searchsorted(hit, "right")).tolist()]
        misread_counts(mine, usual, pairs, total)
        misread_counts(mine, before, pairs, total, -1)

    return _counted(df, text, count)


def garbled_rows(df: DataFrame, text: str, model: Model) -> DataFrame:
    """(text, spans, signs) of the rows in which ``model`` confirms a garbled span: the text, its labelled spans and their signs."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = [t for t in b.column(0).to_pylist() if t]
            todo = m.doubtful(texts)
            found = [(texts[i], len(_spans(path)), int((path > 0).sum())) for i, path in zip(todo, label(m, [texts[i] for i in todo]), strict=True) if path.any() and restore(m, texts[i], path)[1]]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), *(pa.array([f[k] for f in found], pa.int64()) for k in (1, 2))], names=[text, "spans", "signs"])

    return df.select(text).mapInArrow(run, StructType([StructField(text, StringType()), StructField("spans", LongType()), StructField("signs", LongType())]))


def entering(spans: int, clean_signs: int) -> float:
    """Log-probability of entering a garbled span, from the spans found in so many clean signs and what is known beforehand."""
    return float(np.log((spans + np.exp(ENTER) * PRIOR_SIGNS) / (clean_signs + PRIOR_SIGNS))) + LENIENT


def fit_model(df: DataFrame, id: str, text: str, together: int = TOGETHER, pairs: list[tuple[str, str]] = PAIRS) -> Model | None:
    """Fit every state and the entering on all rows; rows the first fit finds garbled are left out of the second.

    What the rows left out held is taken off the counts, so that only they are counted again.
    """
    counts = sign_counts(df, text)
    if not counts:
        return None
    clean = without_lost(counts)
    wide = pair_counts(df, text, usual_signs(clean), pairs, together)
    first = fit_counts(clean, wide, pairs)
    garbled = cut(garbled_rows(df, text, first))
    spans, signs = garbled.agg(F.coalesce(F.sum("spans"), F.lit(0)), F.coalesce(F.sum("signs"), F.lit(0))).first()
    enter = entering(spans, sum(counts.values()) - signs)
    counts.subtract(sign_counts(garbled, text))
    second = first
    if left := without_lost(counts):
        usual = usual_signs(left)
        if usual != first.usual:
            for k, n in pair_changes(df, text, first.usual, usual, pairs).items():
                wide.setdefault(k, Counter()).update(n)
        out = pair_counts(garbled, text, usual, pairs, together)
        second = fit_counts(left, {k: n - out.get(k, Counter()) for k, n in wide.items()}, pairs)
    second.enter = enter
    return second


def restore_encoding(df: DataFrame, id: str, text: str, model: Model | None = None, only_found: bool = False) -> DataFrame:
    """(id, text, garbled, spans) of each row: the text restored as far as its bytes allow.

    Narrow: no shuffle but for the model's counts and the few rows it first finds garbled.  ``only_found`` keeps affected rows and leaves their texts out.
    """
    model = model or fit_model(df, id, text)
    plain = StructType([df.schema[id]]) if only_found else StructType([df.schema[id], StructField(text, StringType()), StructField("garbled", BooleanType()), StructField("spans", IntegerType())])
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            r = repair(m, texts) if m else [(t, 0) for t in texts]
            if only_found:
                yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array([n > 0 for _, n in r], pa.bool_()))], names=[id])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t for t, _ in r], pa.string()), pa.array([n > 0 for _, n in r], pa.bool_()), pa.array([n for _, n in r], pa.int32())], names=[id, text, "garbled", "spans"])

    return df.select(id, text).mapInArrow(run, plain)

"""Problem 7: every text as the token ids of a public byte-level BPE tokenizer.

Method: a priority queue of merge ranks over a doubly linked list of symbols; stale queue entries
are skipped.  Decoding concatenates vocabulary strings.  Two exact short cuts spare most of the
merging: a piece seen before in the task is taken from memory, and a piece is cut where no
vocabulary string holds the two bytes on both sides, as no merge can ever reach over such a place.

Empty and null texts give an empty list.  Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from lawweave.llm.common import category_class, tokenizer_dir

#: Pieces kept in a task's memory; the oldest half goes when it is full.  Only speed depends on it.
MEMORY = 400_000
# The white space of Unicode (property White_Space).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache(maxsize=None)
def piece_pattern(basic: bool = False) -> re.Pattern:
    """The published split before merges: contractions, letters, numbers, other signs, white space.

    ``basic``: for texts without characters beyond the basic plane; the same split by shorter character classes.
    """
    letter, number = category_class("L", basic), category_class("N", basic)
    return re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def split_pieces(text: str) -> list[str]:
    """The pieces of the published split; none of their tokens reaches over an end of a piece."""
    return piece_pattern(len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)).findall(text)


@lru_cache(maxsize=None)
def sign_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: kind (0 other, 1 letter, 2 number, 3 white space), and the first and the last byte of its UTF-8."""
    kind = np.fromiter(({"L": 1, "N": 2}.get(unicodedata.category(c)[0], 0) for c in map(chr, range(0x110000))), np.uint8, 0x110000)
    kind[[o for o in range(0x3001) if re.match(f"[{SPACE}]", chr(o))]] = 3
    o = np.arange(0x110000)
    first = np.select([o < 0x80, o < 0x800, o < 0x10000], [o, 0xC0 | o >> 6, 0xE0 | o >> 12], 0xF0 | o >> 18)
    return kind, first.astype(np.uint8), np.where(o < 0x80, o, 0x80 | o & 0x3F).astype(np.uint8)


class BytePairs:
    """One byte-level vocabulary given as ranks: encodes and decodes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.strings = {i: b for b, i in ranks.items()}
        self.inside = {b[i : i + 2] for b in ranks for i in range(len(b) - 1)}
        self.memory: dict[str, bytes] = {}
        self.counts: dict[str, int] = {}
        self.atoms: dict[bytes, bytes] = {}
        self.lengths: dict[bytes, tuple[int, ...]] = {}
        self.apart = np.zeros(1 << 16, bool)  # by two bytes side by side: whether a sign begins between them that no token reaches over
        self.apart.reshape(256, 256)[:, 0xC0:] = True
        self.apart[[b[0] << 8 | b[1] for b in self.inside]] = False
        self.cuts = self.apart.tobytes()
        self.loose = np.ones(1 << 16, bool)  # the same for any sign, ASCII too
        self.loose[[b[0] << 8 | b[1] for b in self.inside]] = False
        self.single = np.zeros(0x110000, np.int8)  # by code point: tokens of the sign alone, 0 where not yet asked

    @classmethod
    def load(cls, name: str, folder: str | None = None) -> BytePairs:
        with open(os.path.join(tokenizer_dir(folder), f"{name}.tiktoken"), "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a})

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one piece by repeated merging of the adjacent pair of lowest rank, leftmost first."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        sym: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        prev, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(r, i, p) for i in range(n - 1) if (r := ranks.get(p := piece[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, whole = heapq.heappop(queue)
            j = after[i]
            if sym[i] is None or j >= n or len(sym[i]) + len(sym[j]) != len(whole):  # stale: a side was merged meanwhile
                continue
            sym[i], sym[j] = whole, None
            after[i] = k = after[j]
            if k < n:
                prev[k] = i
                if (r := ranks.get(p := whole + sym[k])) is not None:
                    heapq.heappush(queue, (r, i, p))
            if (h := prev[i]) >= 0 and (r := ranks.get(p := sym[h] + whole)) is not None:
                heapq.heappush(queue, (r, h, p))
        return [ranks[s] for s in sym if s is not None]

    def piece(self, piece: str) -> bytes:
        """Ids of one piece as packed 32-bit integers."""
        b = piece.encode("utf-8", "replace")
        out, start, inside, atoms = [], 0, self.inside, self.atoms
        cuts = [i for i in range(1, len(b)) if b[i] >= 0xC0 and b[i - 1 : i + 1] not in inside] if len(b) > 3 else []
        for end in (*cuts, len(b)):
            atom = b[start:end]
            ids = atoms.get(atom)
            if ids is None:
                ids = np.array(self.merge(atom), np.int32).tobytes()
                if len(atom) <= 64:
                    if len(atoms) >= MEMORY:
                        for k in list(atoms)[: MEMORY // 2]:
                            del atoms[k]
                    atoms[atom] = ids
            out.append(ids)
            start = end
        return b"".join(out)

    def encode_packed(self, text: str) -> bytes:
        memory, out = self.memory, []
        for p in split_pieces(text):
            ids = memory.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(p) <= 64:
                    if len(memory) >= MEMORY:
                        for k in list(memory)[: MEMORY // 2]:
                            del memory[k]
                    memory[p] = ids
            out.append(ids)
        return b"".join(out)

    def atom(self, atom: bytes) -> tuple[int, ...]:
        """Bytes in each token of a stretch that no token reaches out of."""
        known = self.lengths.get(atom)
        if known is None:
            known = tuple(len(self.strings[t]) for t in self.merge(atom))
            if len(atom) <= 64:
                if len(self.lengths) >= MEMORY:
                    self.lengths.clear()
                self.lengths[atom] = known
        return known

    def last_tokens(self, raw: bytes, need: int) -> list[int]:
        """Bytes in each of the last tokens of a piece: whole stretches, until they have ``need`` tokens or the piece is at its end."""
        out: list[int] = []
        apart, end = self.cuts, len(raw)
        while end and len(out) < need:
            at = end - 1
            while at and not apart[raw[at - 1] << 8 | raw[at]]:
                at -= 1
            out[:0] = self.atom(raw[at:end])
            end = at
        return out

    def count_new(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece, all pieces taken apart in one pass."""
        raw = [p.encode("utf-8", "replace") for p in pieces]
        whole, ends = b"".join(raw), np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        b = np.frombuffer(whole, np.uint8).astype(np.uint16)
        cut = np.append(self.apart[b[:-1] << 8 | b[1:]], True)
        cut[ends - 1] = True
        stops = np.flatnonzero(cut) + 1
        places = stops.tolist()
        atoms = [whole[s:e] for s, e in zip([0, *places], places)]  # noqa: B905
        known = list(map(self.lengths.get, atoms))
        if None in known:
            known = [self.atom(a) if k is None else k for a, k in zip(atoms, known, strict=True)]
        total = np.cumsum(np.fromiter(map(len, known), np.int64, len(known)))[stops.searchsorted(ends)]
        total[1:] -= total[:-1].copy()
        return total.tolist()

    def count_each(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece of the tokenizer's own split."""
        counts = self.counts
        known = list(map(counts.get, pieces))
        if None in known:
            new = list({p: None for p, n in zip(pieces, known, strict=True) if n is None})
            found = dict(zip(new, self.count_new(new), strict=True))
            if len(counts) >= 2 * MEMORY:
                counts.clear()
            counts |= {p: n for p, n in found.items() if len(p) <= 64}
            known = [found[p] if n is None else n for p, n in zip(pieces, known, strict=True)]
        return np.array(known, np.int64)

    def measure(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text the ends of its pieces and the tokens up to each, and the same of its stretches; from 0 tokens on.

        A stretch is what no token reaches out of.  All texts are taken apart in one pass: the published split is a
        rule on neighbouring signs, most stretches are single signs, and only the others are looked up one by one.
        """
        kinds, first, last = sign_table()
        whole = "\0".join([*texts, ""])
        marks = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(codes & 0xFFFFF800 == 0xD800, 63, codes)  # no UTF-8 has halves of surrogate pairs
        kind = kinds[codes]
        kind[marks] = 4
        begins = np.ones(len(codes) + 1, bool)  # of a piece
        begins[1:-1] = kind[1:] != kind[:-1]
        space = kind == 3
        ahead = np.flatnonzero(space[:-1] & ~space[1:] & (kind[1:] != 4))  # white space before a sign: its last one is by itself, or a space that goes with the sign
        begins[ahead] = True
        begins[ahead[codes[ahead] == 32] + 1] = False
        for i in np.flatnonzero((codes == 39) & begins[:-1]).tolist():
            tail = whole[i + 1 : i + 3]
            if n := 2 if tail[:1] in {"s", "t", "m", "d"} else 3 if tail in {"re", "ve", "ll"} else 0:
                begins[i + 1], begins[i + n] = False, True
        begins[marks] = begins[marks + 1] = True
        starts = begins[:-1].copy()  # of a stretch
        starts[1:] |= self.loose[last[codes[:-1]].astype(np.uint16) << 8 | first[codes[1:]]]
        starts = np.flatnonzero(starts)
        stops = np.append(starts[1:], len(codes))
        alone = stops - starts == 1
        signs = codes[starts]
        counts = self.single[signs].astype(np.int64)
        if new := set(signs[alone & (counts == 0)].tolist()):
            self.single[list(new)] = self.count_new(list(map(chr, new)))
            counts = self.single[signs].astype(np.int64)
        more = np.flatnonzero(~alone)
        counts[more] = self.count_each([whole[a:b] for a, b in zip(starts[more].tolist(), stops[more].tolist(), strict=True)])
        at_mark = starts.searchsorted(marks)
        counts[at_mark] = 0
        sums, ended = np.cumsum(counts), begins[stops]
        out, lo, text = [], 0, 0
        for hi, mark in zip(at_mark.tolist(), marks.tolist(), strict=True):
            ends, upto, piece = stops[lo:hi] - text, sums[lo:hi] - (sums[lo - 1] if lo else 0), ended[lo:hi]
            out.append((ends[piece], np.append(0, upto[piece]), ends, np.append(0, upto)))
            lo, text = hi + 1, mark + 1
        return out

    def count_pieces(self, pieces: list[str]) -> int:
        """Tokens of pieces of the tokenizer's own split, together."""
        return int(self.count_each(pieces).sum())

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text or ""), np.int32).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(self.strings[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(name: str, folder: str | None = None) -> BytePairs:
    """A vocabulary of the worker process; loaded once, kept across its tasks."""
    return BytePairs.load(name, folder)


def encode_corpus(df: DataFrame, id: str, text: str, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(id, ids) of every row: a narrow transformation, no shuffle, Arrow batches in and out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer, folder)
        for b in batches:
            packed = [v.encode_packed(t) if t else b"" for t in b.column(1).to_pylist()]
            sizes = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(packed), np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], names=[id, "ids"])

    schema = StructType([df.schema[id], StructField("ids", ArrayType(IntegerType(), False))])
    return df.select(id, text).mapInArrow(run, schema)


def decode_corpus(df: DataFrame, id: str, ids: str = "ids", tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """(id, text) from token ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer, folder)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else v.decode(x) for x in b.column(1).to_pylist()], pa.string())], names=[id, "text"])

    return df.select(id, ids).mapInArrow(run, StructType([df.schema[id], StructField("text", StringType())]))


def round_trip(df: DataFrame, id: str, text: str, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """Per row whether decoding its ids gives the text again (a null text counts as empty).  Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer, folder)
        for b in batches:
            same = [v.decode(v.encode(t)) == (t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(same, pa.bool_())], names=[id, "same"])

    return df.select(id, text).mapInArrow(run, StructType([df.schema[id], StructField("same", BooleanType())]))

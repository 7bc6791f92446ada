"""Problem 1: traces of scanned pages in text, and their repair into continuous paragraphs.

Method: words are summed up into anagram hashes (the sum of one number per sign), so that replacing
one sign by a confusable one changes the hash by a fixed difference.  Which differences stand for a
misrecognition is learned from the corpus: rare words are joined in SQL with frequent ones that are
equal but for one place, and the hash differences that many different word pairs share are kept,
ranked by their number; ``KNOWN`` adds what is known of print beforehand, for corpora too small to
show it.  Rare words are then joined, by hash plus difference, with the frequent words that are a
confusable variant, and the corrections are ranked by the frequent word's count.  Lines at the edges
of pages (page numbers, running headers) are removed, words broken over a line end are joined where
the joined word is attested (hyphen evidence), and the lines of a paragraph become one line.

A word is a run of Latin letters and signs mistaken for them, or, in Chinese, one or two signs with
the sign before and after them.  Counts cover all rows; a repeated clause id counts as often as it
stands.  Null texts stay null, empty ones empty.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from lawweave.session import cut, small

# What a sign of print is often recognised as; (right, recognised).
CONFUSIONS = [tuple(x.split(">")) for x in (
    "应>庆 资>货 人>入 交>茭 保>侏 理>埋 易>昜 金>全 证>诓 户>尸 日>曰 报>扳 清>淸 比>此 司>可 额>颔 未>末 个>午 已>巳 己>已 土>士 天>夭 干>千 大>太 问>间 贝>见 "
    "乌>鸟 拆>折 候>侯 令>今 代>伐 甲>申 由>田 市>巿 处>処 本>木 期>其月 的>白勺 权>木又 信>亻言 机>木几 构>木勾 标>木示 政>正攵 项>工页 场>土昜 现>王见 元>兀 明>日月 对>又寸 取>耳又 "
    "和>禾口 如>女口 好>女子 体>亻本 作>亻乍 付>亻寸 何>亻可 计>讠十 证>讠正 外>夕卜 功>工力 动>云力 加>力口 知>矢口 故>古攵 销>钅肖 银>钅艮"
).split()]
# The same for Latin letters and digits.
LATIN = [tuple(x.split(">")) for x in "e>c h>li m>rn w>vv d>cl t>† i>í l>1 o>0 u>ii g>q I>l O>0 0>O 1>l T>† i>1 i>l n>ri b>h rn>m".split()]
#: A frequent word stands at least so often, and so many times as often as the rare one.
LEAST, RATIO = 12, 15
#: Share of a Chinese sign's occurrences in which another has to follow, for the two to count as one word.
SHARE = 0.005
#: A learned difference stands in so many pairs of words, with so many right words or neighbours on each side, and
#: explains such a share of the rare words with the misread signs (of the signs' occurrences, in Chinese).
PAIRS, SIDES, EXPLAINS, EXPLAINS_HAN = 4, 3, 0.1, 0.5
#: Longest Latin word that differences are learned from; all words are corrected.
LONGEST = 64
#: Most right signs that are learned for one misread sign.
RIGHTS = 3
#: Most corrections or joins that are broadcast; beyond it Spark picks a shuffle join.
BROADCAST_ROWS = 200_000

_HAN = "一-鿿〇㐀-䶿"
_POINT = re.compile(rf"(?<=[{_HAN}%])．(?![0-9A-Za-z])")
_LATIN_WORD = re.compile(r"[A-Za-z0-9†í]{2,}")
_MIXED = re.compile(r"(?<![A-Za-z0-9])(?=[0-9lOIS]*\d)(?=[0-9lOIS]*[lOIS])[0-9lOIS]{2,}(?![A-Za-z0-9])")
_MIXED_HINT = re.compile("[0-9][lOIS]|[lOIS][0-9]")
_HYPHEN = re.compile(r"([A-Za-z†í0-9]{2,}|(?<![A-Za-z†í0-9])[A-Za-z†í])[-‐¬­][ \t　]*$")
_PAGE = re.compile(r"^(?:第\s*[\dlO]+\s*页(?:\s*共\s*[\dlO]+\s*页)?|[-–—－·]\s*[\dlO]{1,4}\s*[-–—－·]|\[[\dlO]{1,4}\]|[\dlO]{1,4}\s*/\s*[\dlO]{1,4}|Page\s+[\dlO]+\s+of\s+[\dlO]+|P\.\s*[\dlO]{1,4}|-\s?[\dlO]+\s?-|[ivxlc]{1,6}|[IVX]{1,6}|\d{1,3})$")
_NUMBERED = re.compile(r"^\d{1,3}[\t ]+|[\t ]{2,}\d{1,3}$")
_PAPER = re.compile(rf"^[{_HAN}]{{4,24}}(?:文件|公报\s*\d+\s*期)$")
_END = re.compile(r"[。；：;:.!?！？”）)】》…]$")
_START = re.compile(r"^(?:第[一二三四五六七八九十百零〇\d]+[条章节编]|Article\s|Chapter\s|[（(][一二三四五六七八九十\d]+[）)]|[一二三四五六七八九十]+、|附件|——|\d+[.、])")


def sign_value(c: str) -> int:
    """The number of a sign: the fifth power of its code point, kept in 62 bits."""
    return pow(ord(c), 5, (1 << 61) - 1)


def anagram(word: str) -> int:
    return sum(map(sign_value, word)) % ((1 << 61) - 1)


MODULUS = (1 << 61) - 1


def _is_latin(sign: str) -> bool:
    return sign.isascii() or sign in "†í"


class Confusions:
    """What a sign, or two signs, may have been before they were misread: pairs (seen, right), the best ranked first."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.pairs = list(dict.fromkeys(pairs))
        self.difference = {(s, r): (anagram(r) - anagram(s)) % MODULUS for s, r in self.pairs}
        self._like: dict[str, str] = {}
        for s, r in self.pairs:
            if len(s) == len(r) == 1 and (a := self._first(s)) != (b := self._first(r)):
                self._like[max(a, b)] = min(a, b)
        self._parts: dict[str, str] = {}
        for s, r in self.pairs:
            one, two = sorted((s, r), key=len)
            if len(one) == 1 < len(two):
                self._parts.setdefault(self._first(one), two)
        self._forms: dict[str, str] = {}
        seen = sorted({s for s, _ in self.pairs if not _is_latin(s[0])}, key=len, reverse=True)
        self.odd_han = re.compile(rf"(?=([{_HAN}0-9](?:{'|'.join(map(re.escape, seen))})[{_HAN}]))" if seen else r"(?!)")
        seen = sorted({s for s, _ in self.pairs if _is_latin(s[0])}, key=len, reverse=True)
        self.odd_latin = re.compile("|".join(map(re.escape, seen)) or r"(?!)")

    def __getstate__(self) -> list:
        return self.pairs

    def __setstate__(self, pairs: list) -> None:
        self.__init__(pairs)

    def _first(self, sign: str) -> str:
        while sign in self._like:
            sign = self._like[sign]
        return sign

    def _form(self, sign: str, above: tuple[str, ...] = ()) -> str:
        c = self._first(sign)
        if c not in self._parts or c in above:
            return c
        return "".join(self._form(x, (*above, c)) for x in self._parts[c])

    def canonical(self, word: str) -> str:
        """A form that all readings of a word share, as far as each sign is taken apart in one way only."""
        for c in word:
            if c not in self._forms:
                self._forms[c] = self._form(c)
        return "".join(map(self._forms.__getitem__, word))

    def places(self, word: str) -> list[tuple[int, str, str]]:
        return [(m.start(), r, s) for s, r in self.pairs if s in word for m in re.finditer(f"(?={re.escape(s)})", word)]

    def is_reading(self, word: str, right: str) -> bool:
        """Whether some subset of the places of a word, each replaced by what it may have been, gives ``right``."""
        if word == right:
            return False
        ends: list[set[int]] = [set() for _ in range(len(word) + 1)]  # where in ``right`` the first signs of the word may end
        ends[0].add(0)
        places = self.places(word)
        for i, c in enumerate(word):
            for seen, x in [(c, c), *((seen, x) for start, x, seen in places if start == i)]:
                if i + len(seen) <= len(word):
                    ends[i + len(seen)].update(j + len(x) for j in ends[i] if right.startswith(x, j))
        return len(right) in ends[-1]

    def targets(self, word: str) -> list[int]:
        """The hashes of the word's readings at one place: its own plus each difference that applies."""
        h = anagram(word)
        return list({(h + self.difference[s, r]) % MODULUS for s, r in self.pairs if s in word})

    def odd_words(self, text: str) -> list[str]:
        """The distinct words of a text that hold a sign which may be misread; a digit before a Chinese sign counts as 0."""
        han = (w if not w[0].isdigit() else f"0{w[1:]}" for w in self.odd_han.findall(text))
        return list(dict.fromkeys([*han, *(w for w in _LATIN_WORD.findall(text) if not w.isdigit() and self.odd_latin.search(w))]))


def _lines(text: str) -> list[str]:
    return [unicodedata.normalize("NFKC", s).strip() if not s.isascii() and re.search("[－０-９［］／]", s) else s.strip() for s in text.split("\n")]


def edge_lines(text: str, title: str | None, publisher: str | None) -> dict[int, str]:
    """Index of every line that belongs to the paper page, with its kind: ``number`` or ``header``.

    A bare number is a page number unless it stands in a table, that is in a run of five or more short lines.
    A running header repeats the beginning of the title or names the publisher's paper.
    """
    lines = _lines(text)
    out: dict[int, str] = {}
    filled = [i for i, s in enumerate(lines) if s]
    if len(filled) < 2:
        return out
    at = 0
    table: set[int] = set()
    while at < len(filled):  # runs of short lines
        end = at
        while end < len(filled) and len(lines[filled[end]]) <= 14:
            end += 1
        run = [lines[i] for i in filled[at:end]]
        if end - at >= 5 and sum(s.isdigit() for s in run) >= 2:
            table.update(filled[at:end])
        at = max(end, at + 1)
    for i in filled:
        s = lines[i]
        if len(s) <= 20 and _PAGE.match(s):
            if i not in table or not s.isdigit():
                out[i] = "number"
        elif len(s) <= 90 and i not in table and not _START.match(s):
            kind = _header_kind(s, title, publisher)
            if kind == "sure" or (kind == "weak" and _breaks_in(lines, filled, i)):
                out[i] = "header"
    return out if len(out) < len(filled) else {}


def _header_kind(s: str, title: str | None, publisher: str | None) -> str:
    """``sure`` with a page number or the publisher beside the title's beginning; ``weak`` for that beginning alone."""
    if _PAPER.match(s):
        return "sure"
    core = _NUMBERED.sub("", s).strip()
    if publisher and core == publisher:  # a signature, unless a page number stands beside it
        return "sure" if core != s else ""
    head = core.split(" · ")[0].strip()
    if title and len(head) >= 8 and title.startswith(head):
        return "sure" if core != s or " · " in core else "weak" if len(head) < len(title) else ""
    return "sure" if publisher and " · " in core and core.endswith(publisher) else ""


_ENTRY = re.compile(r"^(?:[·>•▪*]|\d{1,2}\. )|Notice \[|〔|\d{2}-\d{2}$|^(?:Related|Latest|Most|You may)|^(?:相关|延伸|猜你|热门|本周|专题|最新)")


def _breaks_in(lines: list[str], filled: list[int], i: int) -> bool:
    """Whether a line stands between lines of running text, not among the entries of a list."""
    k = filled.index(i)
    near = [lines[j] for j in (filled[k - 1] if k else -1, filled[k + 1] if k + 1 < len(filled) else -1) if j >= 0]
    return not any(len(x) < 60 and _ENTRY.search(x) for x in near) and any(len(x) >= 20 for x in near)


def _body(text: str, edges: dict[int, str]) -> list[str]:
    return [s for i, s in enumerate(_lines(text)) if s and i not in edges]


def _joined(body: list[str], attested: set[str] | None = None) -> tuple[str, list[tuple[str, str, str, str]], bool]:
    """The lines as paragraphs; hyphenated breaks (left, sign, right, word), joined for now; whether Chinese lines were joined.

    Chinese lines are joined where the break is sure or its two signs are ``attested`` (None: all are); a single
    letter before a plain hyphen where the joined word is.
    """
    out: list[str] = []
    breaks, han = [], False
    last = ""
    for s in body:
        prev = out[-1] if out else ""
        m = _HYPHEN.search(prev)
        nxt = re.match(r"[A-Za-z†í0-9]+", s)
        if m and nxt and not _START.match(s) and (len(m[1]) > 1 or prev[m.end(1)] != "-" or attested is None or (m[1] + nxt[0]).lower() in attested):
            breaks.append((m[1], prev[m.end(1)], nxt[0], m[1] + nxt[0]))
            out[-1] = prev[: m.end(1)] + s
        elif prev and not _END.search(prev) and not _START.match(s) and re.match("[a-z†í0-9]", s) and re.search("[A-Za-z†,0-9’”]$", prev) and " " in prev:
            out[-1] = f"{prev} {s}"
        elif prev and any(w := wraps([last, s])) and (attested is None or w[0] or w[1][0] in attested):
            out[-1], han = prev + s, True
        else:
            out.append(s)
        last = s
    return "\n".join(out), breaks, han


_TAIL, _HEAD = re.compile(rf"[{_HAN}，、\d%]$"), re.compile(rf"[{_HAN}，、。；\d．.%]")
_MENU = re.compile(r"[|｜>»—/]|  |：|\t")


def wraps(body: list[str]) -> tuple[bool, list[str]]:
    """Line ends inside a sentence of Chinese: a sure one (inside a number, or before a comma), and the pairs of signs around the others.

    Such a pair is evidence of a broken word where the signs also stand together inside lines.
    """
    sure, pairs = False, []
    for a, b in zip(body, body[1:], strict=False):
        if len(a) >= 10 and not _END.search(a) and not _START.match(b) and _TAIL.search(a) and _HEAD.match(b) and re.search("[，。；、]", a + b) and not _MENU.search(a) and not _ENTRY.search(a):
            if _START.match(a) and len(a) < 20 and "，" not in a:
                continue  # a heading
            if b[0] in "，、。；％%．" or (a[-1].isdigit() and (b[0].isdigit() or b[0] == ".")) or (a[-1] in "，、" and len(b) > 2):
                sure = True
            else:
                pairs.append(a[-1] + b[0])
    return sure, pairs


def _signs(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _grams(o: np.ndarray, word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``k`` signs that are all Chinese (the first may be a digit), each as one number, and how often each stands."""
    n = max(0, len(o) - k + 1)
    ok = (word[:n] & (True if k > 2 else o[:n] != 48)) if n else np.zeros(0, bool)
    g = np.zeros(n, np.int64)
    for i in range(k):
        g = g << 16 | o[i : i + n]
        if i:
            ok = ok & word[i : i + n] & (o[i : i + n] != 48)
    return np.unique(g[ok], return_counts=True)


def _counted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of Chinese signs side by side in a line; and stretches of three and four once broken lines are joined."""
    out = []
    for joined, sizes in (("\n".join(texts), (2,)), ("\n".join(map(_flat, texts)), (3, 4))):
        o = _signs(joined)
        digit = (o >= 48) & (o <= 57)
        o[digit] = 48
        word = ((o >= 0x4E00) & (o <= 0x9FFF)) | ((o >= 0x3400) & (o <= 0x4DBF)) | (o == 0x3007) | digit
        out += [_grams(o, word, k) for k in sizes]
    return out


def _strings(grams: np.ndarray, k: int) -> list[str]:
    signs = np.stack([(grams >> 16 * (k - 1 - i)) & 0xFFFF for i in range(k)], 1).astype(np.uint32) if len(grams) else np.zeros((0, k), np.uint32)
    all_ = signs.tobytes().decode("utf-32-le", "surrogatepass")
    return [all_[i : i + k] for i in range(0, len(all_), k)]


def _flat(t: str) -> str:
    """The text with line ends inside Chinese, and hyphens at line ends, taken out."""
    if "\n" not in t:
        return t
    t = re.sub(r"(?<=[A-Za-z†í])[-‐¬­][ \t]*\r?\n(?=[a-z†í0-9])", "", t)
    return re.sub(rf"(?<=[{_HAN}，])[ \t\r]*\n(?=[{_HAN}，。．])", "", t)


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n): how often every word stands in all texts; pairs of Chinese signs are marked by a leading space.

    Counted per task before the shuffle; a task's counts are handed on whenever they grow large.
    """

    def rows(c: Counter, grams: list[list[tuple[np.ndarray, np.ndarray]]]) -> pa.RecordBatch:
        words, counts = [*c], [*c.values()]
        for k, parts in zip((2, 3, 4), zip(*grams, strict=True) if grams else (), strict=False):
            u, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            n = np.bincount(at, np.concatenate([m for _, m in parts]), len(u)).astype(np.int64)
            words += [f" {x}" for x in _strings(u, k)] if k == 2 else _strings(u, k)
            counts += n.tolist()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        grams: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for b in batches:
            texts = [t for t in b.column(0).to_pylist() if t]
            c.update(_LATIN_WORD.findall("\n".join(map(_flat, texts))))
            grams.append(_counted(texts))
            if len(c) + sum(len(p) for g in grams for p, _ in g) > 2_000_000:
                yield rows(c, grams)
                c, grams = Counter(), []
        yield rows(c, grams)

    return df.select(text).mapInArrow(run, StructType([StructField("word", StringType()), StructField("n", LongType())])).groupBy("word").agg(F.sum("n").alias("n"))


@pandas_udf(LongType())
def _hash(words: pd.Series) -> pd.Series:
    return words.map(anagram)


def learn_confusions(counts: DataFrame, least: int = LEAST, ratio: int = RATIO) -> list[tuple[str, str, int]]:
    """(seen, right, pairs) of the hash differences that many pairs of a rare and a frequent word share, the most shared first.

    Latin words of four signs or more are joined on what is left when one or two signs of each are masked; Chinese
    ones on the signs before and after.  The rows that come back are bounded by the signs that are misread.
    """
    grams = "flatten(transform(sequence(0, length(word) - 1), i -> transform(filter(array(1, 2), k -> i + k <= length(word)), k -> struct(concat(substring(word, 1, i), '*', substring(word, i + k + 1)) as mask, substring(word, i + 1, k) as gram))))"
    latin = counts.where(F.col("word").rlike("^[A-Za-z0-9†í]{4,}$") & (F.length("word") <= LONGEST) & ~F.col("word").rlike("^[0-9]+$"))
    masked = latin.withColumn("h", _hash("word")).select("word", "n", "h", F.explode(F.expr(grams)).alias("m")).select("word", "n", "h", "m.mask", F.col("m.gram").alias("seen"))
    often = masked.where((F.col("n") >= least) & F.col("word").rlike("^[A-Za-z]+$")).select("mask", F.col("seen").alias("right"), F.col("n").alias("m"), F.col("h").alias("h_right"), F.col("word").alias("w_right"))
    one = (F.substring("seen", 1, 1) != F.substring("right", 1, 1)) & (F.substring("seen", -1, 1) != F.substring("right", -1, 1)) & (F.length("seen") + F.length("right") < 4)
    pairs = masked.join(often, "mask").where((F.col("m") >= ratio * F.col("n")) & one)
    shared = pairs.groupBy((F.col("h_right") - F.col("h")).alias("d"), "seen", "right").agg(F.countDistinct("word").alias("pairs"), F.countDistinct("w_right").alias("rights"))
    rare = masked.where(F.col("n") < least).groupBy("seen").agg(F.countDistinct("word").alias("all"))
    found = shared.join(rare, "seen").where((F.col("pairs") >= PAIRS) & (F.col("rights") >= SIDES) & (F.col("pairs") >= EXPLAINS * F.col("all"))).select("seen", "right", "pairs")
    han = counts.where(F.col("word").rlike(f"^[0{_HAN}][{_HAN}]{{2,3}}$")).select(F.substring("word", 1, 1).alias("a"), F.substring("word", -1, 1).alias("b"), F.expr("substring(word, 2, length(word) - 2)").alias("seen"), "n")
    right = han.where((F.length("seen") == 1) & (F.col("n") >= least)).select("a", "b", F.col("seen").alias("right"), F.col("n").alias("m"))
    met = han.join(right, ["a", "b"]).where((F.col("m") >= ratio * F.col("n")) & ~F.col("seen").contains(F.col("right")))
    shared = met.groupBy("seen", "right").agg(F.count("*").alias("pairs"), F.countDistinct("a").alias("before"), F.countDistinct("b").alias("after"), F.sum("n").alias("n"))
    shared = shared.where((F.col("pairs") >= PAIRS) & (F.col("before") >= SIDES) & (F.col("after") >= SIDES))
    shared = shared.join(han.groupBy("seen").agg(F.sum("n").alias("all")), "seen").where(F.col("n") >= EXPLAINS_HAN * F.col("all")).select("seen", "right", "pairs")
    best = F.row_number().over(Window.partitionBy("seen").orderBy(F.desc("pairs"), "right"))
    ranked = found.unionByName(shared).withColumn("rank", best).where(F.col("rank") <= RIGHTS).select("seen", "right", "pairs").collect()
    single = {r.seen for r in ranked if len(r.seen) == 1 and not _is_latin(r.seen)}

    def misread(seen: str, right: str) -> bool:
        """Neither the other letter case nor a traditional form is; two signs of which one is misread by itself are not misread together."""
        if _is_latin(seen[0]):
            return seen.lower() != right.lower()
        return _simplified(seen) and (len(seen) == 1 or not single & set(seen))

    return sorted(((r.seen, r.right, r.pairs) for r in ranked if misread(r.seen, r.right)), key=lambda x: (-x[2], x))


def _simplified(s: str) -> bool:
    try:
        return bool(s.encode("gb2312"))
    except UnicodeEncodeError:
        return False


def confusions(counts: DataFrame, known: list[tuple[str, str]] | None = None) -> Confusions:
    """What the corpus shows, the most shared first, and what is ``known`` beforehand (right, seen)."""
    known = CONFUSIONS + LATIN if known is None else known
    return Confusions([(s, r) for s, r, _ in learn_confusions(counts)] + [(s, r) for r, s in known])


def corrections(counts: DataFrame, table: Confusions | None = None, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """(word, right, n, n_right): for each rare word its best frequent confusable variant.

    The join is on the anagram hash plus the difference of one confusion; a word with several doubtful places is
    joined on the hash of the form that all its readings share, so that no subset of places is left out.  That the
    signs are also in the right order is checked on the joined rows.  Ranked by the frequent word's count, then by
    the word.
    """
    t = confusions(counts) if table is None else table

    @pandas_udf(ArrayType(LongType()))
    def targets(words: pd.Series) -> pd.Series:
        return words.map(t.targets)

    @pandas_udf(LongType())
    def canonical(words: pd.Series) -> pd.Series:
        return words.map(lambda w: anagram(t.canonical(w)))

    @pandas_udf(BooleanType())
    def several(words: pd.Series) -> pd.Series:
        return words.map(lambda w: len({i for i, _, _ in t.places(w)}) > 1)

    @pandas_udf(BooleanType())
    def reading(words: pd.Series, rights: pd.Series) -> pd.Series:
        return pd.Series([t.is_reading(w, r) for w, r in zip(words, rights, strict=True)], dtype=bool)

    seen = "|".join(re.escape(s) for s in {s for s, _ in t.pairs})
    mine = counts.where((F.length("word") >= 2) & ~F.col("word").startswith(" ")).select("word", "n")
    often = mine.where(F.col("n") >= least).select(F.col("word").alias("right"), F.col("n").alias("n_right"))
    odd = mine.where(F.col("word").rlike(seen) & ~F.col("word").rlike("^[0-9]+$"))
    enough = F.col("n_right") >= ratio * F.col("n")
    one = odd.select("word", "n", F.explode(targets("word")).alias("h")).join(often.withColumn("h", _hash("right")), "h")
    more = odd.where(several("word")).withColumn("h", canonical("word")).join(often.withColumn("h", canonical("right")), "h")
    columns = ("word", "right", "n", "n_right")
    both = one.where(enough).select(*columns).unionByName(more.where(enough).select(*columns)).distinct().where(reading("word", "right"))
    both = both.where((F.length("word") >= 3) | ~F.col("word").rlike("[ -~í]$") | F.col("word").rlike("[†0-9]"))
    best = both.groupBy("word", "n").agg(F.max(F.struct("n_right", "right")).alias("b"))
    return best.select("word", "b.right", "n", "b.n_right")


def attested_words(counts: DataFrame, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """Latin words, in lower case, that stand often enough in any case, and pairs of Chinese signs of which the first is followed by the second in a fair share of cases."""
    latin = counts.where(F.col("word").rlike("^[A-Za-z]{2,}$")).groupBy(F.lower("word").alias("word")).agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("word")
    pairs = counts.where(F.col("word").startswith(" ")).select(F.substring("word", 2, 2).alias("word"), "n")
    firsts = pairs.groupBy(F.substring("word", 1, 1).alias("first")).agg(F.sum("n").alias("all"))
    tied = pairs.join(F.broadcast(firsts), F.substring("word", 1, 1) == F.col("first"))  # a row per Chinese sign
    return latin.unionByName(tied.where((F.col("n") >= least) & (F.col("n") >= share * F.col("all"))).select("word"))


def _evidence(texts: list[str | None], titles: list, publishers: list, table: Confusions) -> Iterator[tuple[bool, list[str], list[str]]]:
    """Per text: a sure trace; words that may be misrecognised; words that may have been broken."""
    for t, title, publisher in zip(texts, titles, publishers, strict=True):
        if not t:
            yield False, [], []
            continue
        sure, joins, flat = False, [], t
        if "\n" in t:
            edges = edge_lines(t, title, publisher)
            body = _body(t, edges)
            sure, pairs = wraps(body)
            sure = sure or bool(edges) or "\f" in t  # a form feed is the end of a page
            if not sure:
                flat, breaks, _ = _joined(body)
                sure = any(sign in "¬­" for _, sign, _, _ in breaks)
                joins = [w.lower() for *_, w in breaks] + pairs
        sure = sure or bool(_MIXED_HINT.search(flat) and _MIXED.search(flat)) or bool("．" in flat and _POINT.search(flat))
        yield sure, [] if sure else table.odd_words(flat), joins


def find_traces(df: DataFrame, id: str, text: str, title: str, publisher: str) -> DataFrame:
    """Ids of the rows with at least one trace of a scanned page.

    Sure traces come from the lines alone; doubtful words become rows and are joined with the corrections,
    doubtful breaks with the attested words.
    """
    counts = cut(word_counts(df, text))
    table = confusions(counts)
    right = corrections(counts, table).select("word").withColumn("kind", F.lit(1))
    attested = attested_words(counts).select("word", F.lit(2).alias("kind"))
    sure = df.sparkSession.createDataFrame([("", 0)], "word string, kind int")
    accepted = small(cut(right.unionByName(attested).unionByName(sure)), BROADCAST_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, kinds, words = [], [], []
            for i, (sure, odd, joins) in enumerate(_evidence(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), table)):
                got = [(0, "")] if sure else [(1, w) for w in odd] + [(2, w) for w in joins]
                ids += [i] * len(got)
                kinds += [k for k, _ in got]
                words += [w for _, w in got]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(kinds, pa.int32()), pa.array(words, pa.string())], names=[id, "kind", "word"])

    schema = StructType([df.schema[id], StructField("kind", IntegerType()), StructField("word", StringType())])
    rows = df.select(id, text, title, publisher).mapInArrow(run, schema)
    return rows.join(accepted, ["kind", "word"], "left_semi").select(id).distinct()


def repair(df: DataFrame, id: str, text: str, title: str, publisher: str) -> DataFrame:
    """(id, text) of every row: edge lines gone, broken words joined, corrections applied, whole paragraphs.

    The corrections of a text are looked up by a join on its doubtful words and come back to it by id.
    Texts without a trace pass unchanged.  Repeated ids give one row.
    """
    counts = cut(word_counts(df, text))
    table = confusions(counts)
    fixes = small(cut(corrections(counts, table).select("word", "right")), BROADCAST_ROWS)
    attested = small(cut(attested_words(counts).select("word", F.col("word").alias("right"))), BROADCAST_ROWS)
    df = df.select(id, text, title, publisher).dropDuplicates([id])

    def doubts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, words, kinds = [], [], []
            for i, (t, ti, pu) in enumerate(zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
                if not t:
                    continue
                body = _body(t, edge_lines(t, ti, pu))
                flat, breaks, _ = _joined(body)
                odd = table.odd_words(flat)
                joins = [w.lower() for *_, w in breaks] + wraps(body)[1]
                ids += [i] * (len(odd) + len(joins))
                words += odd + joins
                kinds += ["fix"] * len(odd) + ["join"] * len(joins)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(words, pa.string()), pa.array(kinds, pa.string())], names=[id, "word", "kind"])

    rows = df.mapInArrow(doubts, StructType([df.schema[id], StructField("word", StringType()), StructField("kind", StringType())]))
    known = rows.where("kind = 'fix'").join(fixes, "word").unionByName(rows.where("kind = 'join'").join(attested, "word"))
    per = known.groupBy(id).agg(F.collect_list(F.struct("kind", "word", "right")).alias("fixes"))  # bounded by one text's words

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(1, 5)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_repaired(*x) for x in zip(*cols, strict=True)], pa.string())], names=[id, text])

    return df.join(per, id, "left").mapInArrow(apply, StructType([df.schema[id], StructField(text, StringType())]))


def _repaired(t: str | None, title: str | None, publisher: str | None, fixes: list | None) -> str | None:
    if not t:
        return t
    edges = edge_lines(t, title, publisher)
    body = _body(t, edges)
    fix = {f["word"]: f["right"] for f in fixes or [] if f["kind"] == "fix"}
    ok = {f["word"] for f in fixes or [] if f["kind"] == "join"}
    flat, breaks, han = _joined(body, ok)
    if not (edges or han or fix or _MIXED.search(flat) or _POINT.search(flat) or any(sign != "-" or w.lower() in ok or w in fix for _, sign, _, w in breaks)):
        return t
    for left, sign, r, word in breaks:  # an unattested word at a plain hyphen keeps it: a compound
        if sign == "-" and word.lower() not in ok and word not in fix:
            flat = flat.replace(word, f"{left}-{r}", 1)
    flat = _MIXED.sub(lambda m: m[0].translate(str.maketrans("lIOS", "1105")), flat)
    flat = _LATIN_WORD.sub(lambda m: fix.get(m[0], m[0]), flat)
    for w, r in sorted(((w, r) for w, r in fix.items() if not _is_latin(w[-1])), key=lambda x: -len(x[0])):
        if w[0] == "0":  # any digit
            flat = re.sub(rf"(?<=\d){re.escape(w[1:])}", r[1:], flat)
        else:
            flat = flat.replace(w, r)
    return _POINT.sub("。", flat)

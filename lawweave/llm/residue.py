"""Problem 6: template residue, filler and error messages in place of content.

Method: positive-unlabelled naive Bayes by expectation-maximisation.  Trusted positives are short
records that consist of one of a few well-known messages or of bare placeholders (``TRUSTED``); all
other records are unlabelled.  Each record is cut into passages: its sentences, every name between
template-like signs (a slot), and every foreign word set directly into running Chinese.  So one
unfilled slot inside a finished provision is a passage of its own.  The classes' feature shares and
the class shares of each kind of passage are estimated from the trusted passages and the unlabelled
ones' posterior weights, in turns; nothing but the learned weights decides about a passage.  A record
is residue where one of its passages is.

The model is fitted on a bounded sample (``SAMPLE`` trusted and ``UNLABELLED`` other records); every
record is scored, whole.  Null and empty texts are never residue.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from lawweave.llm.common import hash_sample

#: Most trusted and other records the model is fitted on, and the turns of expectation and maximisation.
SAMPLE, UNLABELLED, ROUNDS = 5_000, 20_000, 12
#: Longest record, in characters, that can be trusted as a bare message.
SHORT = 160
#: Log-odds from which a passage counts as residue, by its kind: text, slot, word in place.
THRESHOLD = (3.0, 0.0, 0.0)
#: Features that count in full in one passage; of more, the mean counts so many times.
WIDE = 12
# What a trusted record holds.  Java regex, also valid in Python.
TRUSTED = (
    r"(?is)(enable javascript|启用 ?javascript|禁用了脚本|\bnot found\b|access denied|checking your browser|nullpointerexception|访问的页面|系统繁忙|正在加载|重新登录|验证失败|在线预览|"
    r"请求已被.{0,8}拦截|lorem ipsum|占位文本|在此输入|\[object object\]|^\W*([一-鿿]{2,6})\2{4,}\W*$|"
    r"^\W*(\{\{|\$\{|\[\[)[^\n]{0,60}(\}|\]\])\n|^\W*(undefined|null|none|nan)\b[^。]{0,20}$|经XX公司)"
)

_HEAD = re.compile(r"^\s*(?:第[一二三四五六七八九十百零〇0-9]{1,8}条|Article \d+|（[一二三四五六七八九十]+）|\(\d+\))[\s　]*")
_OPEN, _CLOSE = r"[{}$#%<\[@~^=]", r"[{}$#%>\]@~^=]"
#: A name between signs, whatever the signs: up to the closing ones in the same line.
_SLOT = re.compile(rf"(?<![0-9]){_OPEN}{{1,3}}[ \t]*([A-Za-z_一-鿿][^{{}}$#%<>\[\]@~^=\n。；，]*?)[ \t]*{_CLOSE}{{1,3}}|(?<!_)__[A-Za-z_.一-鿿]*?__(?!_)")
#: A Latin word (or value of a program) that touches Chinese or stands for itself in it.
_EDGE = r"[^\s一-鿿，。；：、（）()“”0-9-]"
_PLACED = re.compile(rf"(?<!{_EDGE})(?:(?<=[一-鿿])[ ]?#?[A-Za-z]+(?:/[A-Za-z])?[!?]?(?!{_EDGE}|[0-9])|(?<![0-9])#?[A-Za-z]+(?:/[A-Za-z])?[!?]?[ ]?(?=[一-鿿]))")
_NAME = re.compile(r"[A-Za-z]+|[一-鿿]+|[0-9]+")
_TOKEN = re.compile(r"[一-鿿㐀-䶿]+|[A-Za-zÀ-ɏ]*[0-9][A-Za-z0-9]*|[A-Za-zÀ-ɏ]+")
_RUN = re.compile(r"([A-Za-z])\1+")
KINDS, PLACES = 3, ("quoted", "inside", "beside", "alone")


def passages(text: str) -> list[tuple[int, tuple[str, ...]]]:
    """(kind, distinct features) of the passages of a record; kinds: 0 its text, 1 slot, 2 word in place."""
    out = []
    body = _HEAD.sub("", text)
    bare = body.strip()
    slots = list(_SLOT.finditer(body))
    for m in slots:
        whole = m.group()
        names = [y for x in _NAME.findall((m.group(1) or whole).split("|")[0]) for y in ([x.lower()] if x.isascii() else [x[i : i + 2] for i in range(len(x) - 1)])]
        signs = re.match(rf"({_OPEN}+).*?({_CLOSE}+)$", whole, re.S)
        shape = f"{signs[1]}w{signs[2]}" if signs else "__w__"
        out.append((1, tuple(dict.fromkeys([f"s:{shape}", f"s:{_where(body, m)}", *(f"n:{x}" for x in names)]))))
    for m in _PLACED.finditer(body):
        word = _RUN.sub(r"\1\1", m.group().strip())
        out.append((2, (f"i:{word}", f"i:{_where(body, m)}")))
    rest = _SLOT.sub(" ", body) if slots else body
    f: dict[str, None] = {}
    n = again = 0
    for t in _TOKEN.findall(rest):
        if "㐀" <= t[0] <= "鿿":
            for i in range(len(t) - 1):
                n += 1
                again += t[i : i + 2] in f
                f[t[i : i + 2]] = None
            if len(t) == 1:
                f[t] = None
        else:
            n += 1
            w = "§0" if t.isdigit() else "§id" if any(c.isdigit() for c in t) else t.lower()
            again += w in f and w[0] != "§"
            f[w] = None
    if f:
        if n > 7 and again > n / 2:  # filler: however long, it says little
            f["§repeats"] = None
        else:
            f[f"§size{min(7, n.bit_length())}"] = None
            f["§end" + (bare[-1] if bare[-1] in "。；！？.…)）" else "")] = None
        out.append((0, tuple(f)))
    return out


def _where(body: str, m: re.Match) -> str:
    """Where a passage stands: in quotation marks, inside running text, beside it, or alone in its line."""
    if body.count("“", 0, m.start()) > body.count("”", 0, m.start()):
        return "quoted"
    before, after = body[max(0, m.start() - 1) : m.start()], body[m.end() : m.end() + 1]
    if before.isalnum() or after.isalnum() or before == "%":
        return "inside"
    return "beside" if before.strip() or after.strip() else "alone"


class Bayes:
    """Weights of the features and the log-odds of each kind of passage; a feature without a weight says nothing."""

    def __init__(self, weight: dict[str, float], prior: tuple[float, ...], threshold: tuple[float, ...] = THRESHOLD):
        self.weight, self.prior, self.threshold = weight, prior, threshold
        self._up = None

    def _possible(self, text: str) -> bool:
        """Whether the text or a word in place could reach its threshold, by its favourable features alone.

        Every Chinese sign is in a feature of at most two signs, which bounds the number of features from below.
        """
        if self._up is None:
            import ahocorasick

            own = {x: w for x, w in self.weight.items() if w > 0}
            self._up = ahocorasick.Automaton()
            for x, w in [*own.items(), ("\0", 0.0)]:
                if x[0] != "§" and x[1:2] != ":":
                    self._up.add_word(x, (x, w))
            self._up.make_automaton()
            self._rest = sum(sorted((w for x, w in own.items() if x[0] == "§"), reverse=True)[:4])
            words = sorted((x[2:] for x in own if x.startswith("i:") and x[2:] not in PLACES), key=len, reverse=True)
            self._words = re.compile("|".join(map(re.escape, words)) or r"(?!)")
        if self._words.search(text):
            return True
        most = self._rest + sum(w for _, w in {v for _, v in self._up.iter(text.lower())})
        few = sum("㐀" <= c <= "鿿" for c in set(text)) / 2
        return self.prior[0] + most * min(1.0, WIDE / max(1.0, few)) > self.threshold[0]

    def score(self, text: str) -> float:
        """The largest excess of a passage's log-odds over the threshold of its kind."""
        best, w = -1e9, self.weight
        for kind, p in passages(text):
            s = self.prior[kind] + sum(w.get(x, 0.0) for x in p) * min(1.0, WIDE / len(p)) - self.threshold[kind]
            best = max(best, s)
        return best

    def is_residue(self, text: str) -> bool:
        return (bool(_SLOT.search(text)) or self._possible(text)) and self.score(text) > 0

    def __getstate__(self) -> tuple:
        return self.weight, self.prior, self.threshold

    def __setstate__(self, s: tuple) -> None:
        self.__init__(*s)


def fit(trusted: list[str], unlabelled: list[str], scale: float = 1.0, rounds: int = ROUNDS) -> Bayes:
    """Expectation-maximisation: trusted passages are positive; those of unlabelled records start as negative.

    ``scale``: how many unlabelled records each one given stands for, relative to the trusted ones.
    The expectation is the posterior itself; a feature speaks for residue only if the weight of the passages with it
    that count as residue is more than one passage's.
    """
    pos = [p for t in trusted for p in passages(t)]
    unl = [p for t in unlabelled for p in passages(t)]
    names: dict[str, int] = {}
    rows = [np.array([names.setdefault(x, len(names)) for x in f], np.int64) for _, f in pos + unl]
    kind = np.array([k for k, _ in pos + unl], np.int64)
    of = np.zeros(len(names), np.int64)
    for k, r in zip(kind, rows, strict=True):
        of[r] = k  # every feature belongs to one kind
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    part = np.minimum(1.0, WIDE / np.maximum(1, sizes))
    stands = np.where(np.arange(len(rows)) < len(pos), 1.0, scale)  # for how many passages each one stands
    y = np.zeros(len(rows))
    y[: len(pos)] = 1.0
    v, w, prior = len(names), np.zeros(len(names)), np.zeros(KINDS)
    for _ in range(rounds):
        yes, no = y * stands, (1 - y) * stands
        up, down = np.bincount(flat, yes[owner], v), np.bincount(flat, no[owner], v)
        n_up, n_down = np.bincount(kind, yes, KINDS) + 1.0, np.bincount(kind, no, KINDS) + 1.0
        w = np.log((up + 0.1) / n_up[of]) - np.log((down + 0.5) / n_down[of])
        w[(up < 1.5) & (w > 0)] = 0.0
        prior = np.log(n_up / n_down)
        s = np.clip(np.bincount(owner, w[flat], len(rows)) * part + prior[kind], -30, 30)
        y = 1 / (1 + np.exp(-s))
        y[: len(pos)] = 1.0
    return Bayes({x: float(w[i]) for x, i in names.items() if abs(w[i]) > 0.05}, tuple(prior.tolist()))


def is_trusted(text: str):
    """Column: the record is short and holds a trusted message or bare placeholders."""
    t = F.col(text)
    return (F.length(t) <= SHORT) & F.regexp_replace(t, r"^\s*(第.{1,8}条|Article \d+)[\s　]*", "").rlike(TRUSTED) & ~t.rlike("[“”]")


def fit_model(df: DataFrame, id: str, text: str, bound: int = SAMPLE, others: int = UNLABELLED) -> Bayes | None:
    df = df.where(F.col(text) != "").select(id, text, is_trusted(text).alias("_trusted"))
    n = {r[0]: r[1] for r in df.groupBy("_trusted").count().collect()}
    if len(n) < 2:
        return None
    trusted, rest = ([r[1] for r in hash_sample(df.where(F.col("_trusted") == k), id, b, n[k], text)] for k, b in ((True, bound), (False, others)))
    return fit(trusted, rest, (n[False] / len(rest)) / (n[True] / len(trusted)))


def score_records(df: DataFrame, id: str, text: str, model: Bayes | None = None, only_found: bool = False) -> DataFrame:
    """(id, score, residue) of every record; ``only_found``: just the ids of residue.  Narrow, no shuffle."""
    model = model or fit_model(df, id, text)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            if only_found:
                hit = pa.array([bool(m and t and m.is_residue(t)) for t in texts], pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0).filter(hit)], names=[id])
            else:
                s = [m.score(t) if m and t else -1e9 for t in texts]
                hit = pa.array([x > 0 for x in s], pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), hit], names=[id, "score", "residue"])

    schema = StructType([df.schema[id]] + ([] if only_found else [StructField("score", DoubleType()), StructField("residue", BooleanType())]))
    return df.select(id, text).mapInArrow(run, schema)


def exclude_residue(df: DataFrame, id: str, text: str, model: Bayes | None = None) -> DataFrame:
    """``df`` without the rows of residue records; null and empty texts stay."""
    return df.join(score_records(df, id, text, model, only_found=True).distinct(), id, "left_anti")

"""Problem 4: page boilerplate (menus, paths, tools, cookie notices, sidebars, footers) among the text.

Method: gradient-boosted trees over node features and hierarchical decoding.  A flattened page is
read as a tree: the page, its blocks (runs of lines between the lines of running text), their
sections (a line and the entries listed below it), their lines.  The features of a line node are its
density, its attribute tokens, its depth in block and section, and statistics of its siblings, its
section and its block.  Decoding goes up the tree: each node is all page, all text or mixed, whichever
sums to the most log-odds, and passes its choice down, so no ancestor and descendant contradict.

The trees are fitted with Spark ML on a bounded sample (``SAMPLE`` records).  A line is a positive
example if it is a well-known page element (``ELEMENTS``), is listed below one, or if two other lines of
its block are; a negative one if it is running text, stands in a record without any such element, or is
repeated in such records; all other lines are left out of the fit.  What the trees know about a line's
words are the weights of its attribute tokens, and those come only from lines that ANOTHER line of the
block labelled, never from the words of the list itself.  The fitted trees are then applied to every
line of every record, whole records at a time inside the tasks, without a shuffle.  Null and empty texts
have no lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lawweave.llm.common import bounded_sample

#: Most records the trees are fitted on, and the boosting's size.
SAMPLE, ROUNDS, DEPTH = 8_000, 20, 5
#: What a mixed node has to gain over a uniform one, in log-odds.
MIXED = 1.5
#: A line of running text with more signs has no attribute tokens.
LONG = 60
#: Partitions of the sample while the trees are fitted.
FIT_PARTITIONS = 4
# Words and phrases of page elements, by element.
ELEMENTS = {
    "menu": "首页|人才招聘|Accessibility|RSS|WAP|登录|注册|退出|繁体|简体|English|招聘|党建|无障碍|行情|公告|法规制度|规则检索|下载中心|办事指南|互动交流|新闻动态|信息公开|专题专栏|市场服务|会员之家|投资者教育|机构概况|数据统计|网站地图|友情链接|Home|Search|Login|Careers|FAQ|Sitemap|About Us|Contact|News|Rules|Notices|Products|Clearing|Membership|Market Data|Investor Education",
    "path": r"当前位置|您所在的位置|You are here",
    "tools": r"【打印】|字号：|A\+ A-|朗读|关闭窗口|关闭本页|语言：|请输入关键词|☰|Skip to main content|« ?Back to list|上一篇|下一篇|Previous:|Next:|^打印$",
    "cookie": r"[Cc]ookie|本地存储数据|小型文本文件",
    "heading": r"^(相关阅读|延伸阅读|猜你想看|热门文件|本周排行|专题推荐|最新公告|热点推荐|Related documents|Most viewed|You may also like|Latest notices)",
    "footer": r"版权所有|Copyright|All rights reserved|备案序号|技术支持|建议使用|主办：|地址：.{2,30}传真|法律声明|使用帮助|隐私声明|意见征集|手机版|返回顶部|回到首页|Back to top|^TOP$|打开客户端阅读|您是第.{1,12}访客|Terms of Use|联系我们|关于本站",
}
_MENU = re.compile(f"(?:{ELEMENTS['menu']})")
_SURE = re.compile("|".join(f"(?:{v})" for k, v in ELEMENTS.items() if k not in ("menu", "heading")))
_HEADING = re.compile(ELEMENTS["heading"])
_SPLIT = re.compile(r"[\s　|｜/·>»－—\-\[\]【】:：]+")
_BODY = re.compile(r"[。；：;:.!?！？”）)]$")
_START = re.compile(r"^\s*(?:第[一二三四五六七八九十百零〇0-9]+[条章节编]|Article \d|[（(][一二三四五六七八九十0-9]+[）)]|[一二三四五六七八九十]+、|Chapter|附件|附录)")
_BULLET = re.compile(r"^\s*(?:[·>•▪*]|\d{1,2}[.、]\s?)")
_CLAUSE = re.compile(r"[，。；]|[a-z], [a-z]|[a-z]\. ")
_TEXT = re.compile(r"[，。；：]|^\d{4}年|^（此件")
_DATE = re.compile(r"\d{2}-\d{2}$")
_WORDS = re.compile(r"[A-Za-z]+|[一-鿿]{2,}")
_SIGNS = re.compile(r"[|｜>»«·•▪☰©□↑【】：]|\d+-\d+$|^\d+\. ")
_NAMED = re.compile(ELEMENTS["cookie"] + "|地址：|Copyright|版权所有")
_SEPS, _DIGIT, _PUNCT = re.compile(r"[|｜/·>»－—　]|  | - "), re.compile("[0-9]"), re.compile("[。，；、,;]")
CONTENT = 16  # content features of a line; context features follow


@lru_cache(maxsize=100_000)
def content(s: str) -> tuple[float, ...]:
    """Features of a line by itself."""
    n = len(s)
    if not n:
        return (0.0,) * CONTENT
    toks = [t for t in _SPLIT.split(s) if t]
    seps = len(_SEPS.findall(s))
    wide = (len(s.encode("utf-8", "replace")) - n) / 2
    digits = len(_DIGIT.findall(s))
    opened = sum(s.count(a) - s.count(b) for a, b in ("（）", "〔〕", "《》", "()", "[]"))
    return (
        float(np.log1p(n)),
        len(_PUNCT.findall(s)) / n,
        float(bool(_BODY.search(s))),
        float(seps),
        float(max(map(len, toks), default=0)),
        float(len(toks)),
        n / max(1, len(toks)),
        float(bool(_BULLET.match(s))),
        float(bool(_START.match(s))),
        digits / n,
        float("〔" in s or "《" in s or "Notice [" in s),
        float(bool(_DATE.search(s))),
        float(s.count("[") + s.count("【")),
        float(abs(opened)),
        wide / n,
        float(sum(s.count(c) for c in "↑☰□©«")),
    )


@lru_cache(maxsize=100_000)
def is_body(s: str) -> bool:
    """A line of running text: long, or an article's or item's beginning, and with an end of sentence.

    A closing bracket ends a sentence only where there is a clause before it; else it ends a title.
    """
    if not _BODY.search(s) or (s[-1] in "）)”" and not _CLAUSE.search(s)):
        return False
    return len(s) > 24 or bool(_START.match(s))


def blocks(body: list[bool], starts: set[int]) -> list[int]:
    """The block of each line: lines of running text stand alone, the lines between them form blocks.

    The lines of several pages may follow each other; a page begins at each index in ``starts``.
    """
    out, b, open_ = [], -1, False
    for i, running in enumerate(body):
        if running:
            b, open_ = b + 1, False
        elif not open_ or i in starts:
            b, open_ = b + 1, True
        out.append(b)
    return out


def elements(lines: list[str]) -> list[int]:
    """Per line: 2 for a sidebar's heading and 1 for any other well-known page element, 0 for all other lines."""
    out = []
    for s in lines:
        toks = [t for t in _SPLIT.split(s) if t]
        menu = bool(toks) and all(_MENU.fullmatch(" ".join(toks)) or _MENU.fullmatch(t) for t in toks)
        sure = bool(_SURE.search(s)) and (not (is_body(s) or _START.match(s)) or bool(_NAMED.search(s)))
        out.append(2 if _HEADING.match(s) else int(sure or menu))
    return out


def canonical(s: str) -> str:
    return _DIGIT.sub("0", " ".join(s.split()))


def weak_labels(pages: list[list[str]], own: bool = True) -> list[list[int]]:
    """Per line 1 for page, 0 for text, -1 for unknown; without ``own`` by the other lines of its block and by its repetition only."""
    found = [elements(p) for p in pages]
    clean = Counter(canonical(s) for p, e in zip(pages, found, strict=True) if not any(e) for s in p)
    out = []
    for lines, known in zip(pages, found, strict=True):
        if not any(known):
            out.append([0] * len(lines))
            continue
        block = blocks([is_body(s) for s in lines], {0})
        held = Counter(b for b, k in zip(block, known, strict=True) if k)
        y, under = [], False
        for s, b, k in zip(lines, block, known, strict=True):
            body = is_body(s) or bool(_START.match(s))
            under = k == 2 or (under and not k and not body)
            if (body and not k) or clean[canonical(s)] > 1:
                y.append(0)
            elif (k and (own or held[b] > 1)) or (not k and (under or held[b] > 1)):
                y.append(1)
            else:
                y.append(-1)
        out.append(y)
    return out


def sections(lines: list[str], block: list[int]) -> list[int]:
    """The section of each line: inside a block, a line that is no entry of a list begins a section."""
    out, k = [], -1
    for i, s in enumerate(lines):
        if not i or block[i] != block[i - 1] or not (_BULLET.match(s) or _DATE.search(s) or "〔" in s or "Notice [" in s):
            k += 1
        out.append(k)
    return out


@dataclass
class Nodes:
    """The line nodes of several pages: features, their page, block, section and whether an article or item begins."""

    x: np.ndarray
    page: np.ndarray
    block: np.ndarray
    section: np.ndarray
    begins: np.ndarray


def nodes(pages: list[list[str]], weight: dict[str, float]) -> Nodes:
    """Feature matrix of the line nodes: content, attribute tokens, siblings, block and depth in it, page."""
    lines = [s for p in pages for s in p]
    n = len(lines)
    sizes = np.array([len(p) for p in pages])
    page = np.repeat(np.arange(len(pages)), sizes)
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    body = [is_body(s) for s in lines]
    c = np.array([content(s) for s in lines])
    tok = np.array([_NONE if running and len(s) > LONG else _tokens(s, weight) for s, running in zip(lines, body, strict=True)])
    b = np.array(blocks(body, set(start.tolist())))
    sec = np.array(sections(lines, b.tolist()))
    near = np.hstack([c[:, [0, 1, 2, 7, 8, 10, 11]], tok[:, :2]])
    nil = np.zeros((1, near.shape[1]))
    before, after = np.vstack([nil, near[:-1]]), np.vstack([near[1:], nil])
    before[start] = 0
    after[start + sizes - 1] = 0
    inside = np.hstack([_within(b, c, tok), _within(sec, c, tok)])
    run = np.cumsum(body)
    body_ = np.array(body, float)
    base = run[start] - body_[start]
    total = np.bincount(page, body_)
    seen = run - body_ - base[page]
    best = np.maximum.reduceat(tok[:, 1], start)
    whole = np.column_stack([sizes[page].astype(float), total[page] - seen - body_, seen, np.maximum(best, 0)[page]])
    x = np.hstack([c, tok, before, after, inside, whole])
    return Nodes(x, page, b, sec, (c[:, 8] > 0) & (body_ > 0))


def _within(group: np.ndarray, c: np.ndarray, tok: np.ndarray) -> np.ndarray:
    """Per line, of the block or section it is in: size, depth in it and lines below, means of length, density, entries and tokens, best token."""
    size = np.bincount(group)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    depth = np.arange(len(group)) - first[group]
    means = [(np.bincount(group, v) / size)[group] for v in (c[:, 0], c[:, 1], c[:, 7], c[:, 10], c[:, 11], tok[:, 0])]
    return np.column_stack([size[group], depth, size[group] - depth, *means, np.maximum.reduceat(tok[:, 1], first)[group]])


_NONE = (0.0, 0.0, 0.0)


def attribute_tokens(s: str) -> list[str]:
    """The distinct words of a line, Chinese ones as pairs of signs, and its signs by kind."""
    words = (t for w in _WORDS.findall(s) for t in ([w.lower()] if w.isascii() else [w[i : i + 2] for i in range(len(w) - 1)]))
    return list(dict.fromkeys([*words, *(f"§{'0' if m[0].isdigit() else m}" for m in _SIGNS.findall(s))]))


def _tokens(s: str, weight: dict[str, float]) -> tuple[float, float, float]:
    w = [weight.get(t, 0.0) for t in attribute_tokens(s)]
    return (sum(w) / len(w), max(w), min(w)) if w else _NONE


class Trees:
    """Fitted boosted trees as arrays, and the attribute tokens' weights."""

    def __init__(self, trees: list[tuple], rates: list[float], weight: dict[str, float]):
        self.trees, self.rates, self.weight = trees, rates, weight

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for (feature, cut, left, right, value), r in zip(self.trees, self.rates, strict=True):
            at = np.zeros(len(x), np.int32)
            for _ in range(DEPTH):
                f = feature[at]
                inner = f >= 0
                go = x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            out += r * value[at]
        return 2 * out  # Spark's margin is half of the log-odds


def _flatten(root) -> tuple:
    """A Spark ML tree as arrays: feature (-1 in a leaf), threshold, children, value."""
    rows: list[list] = []

    def walk(node) -> int:
        i = len(rows)
        rows.append([-1, 0.0, i, i, node.prediction()])
        if node.subtreeDepth() > 0:
            s = node.split()
            rows[i][0], rows[i][1] = s.featureIndex(), s.threshold()
            rows[i][2], rows[i][3] = walk(node.leftChild()), walk(node.rightChild())
        return i

    walk(root)
    f, c, lo, hi, v = zip(*rows, strict=True)
    return np.array(f, np.int32), np.array(c), np.array(lo, np.int32), np.array(hi, np.int32), np.array(v)


def strip_lines(text: str) -> tuple[list[int], list[str]]:
    """Numbers (from 1, blank ones counted) and trimmed contents of the non-blank lines."""
    got = [(i, t) for i, s in enumerate(text.split("\n"), 1) if (t := s.strip())]
    return [i for i, _ in got], [t for _, t in got]


def token_weights(labelled: list[tuple[str, int]]) -> dict[str, float]:
    """Log-odds of the attribute tokens among labelled lines, smoothed."""
    up, down = Counter(), Counter()
    for s, y in labelled:
        (up if y else down).update(attribute_tokens(s))
    n, m = sum(y for _, y in labelled) + 1, sum(1 - y for _, y in labelled) + 1
    return {t: float(np.log((up[t] + 0.3) / n) - np.log((down[t] + 0.3) / m)) for t in (up | down) if up[t] + down[t] >= 3}


def fit(spark, texts: list[str]) -> Trees | None:
    pages = [x for t in texts if (x := strip_lines(t)[1])]
    labels = [y for p in weak_labels(pages) for y in p]
    if not {0, 1} <= set(labels):
        return None
    weight = token_weights([(s, y) for p, ys in zip(pages, weak_labels(pages, own=False), strict=True) for s, y in zip(p, ys, strict=True) if y >= 0])
    x = nodes(pages, weight).x
    rows = [(k, float(y), Vectors.dense(r)) for k, (y, r) in enumerate(zip(labels, x, strict=True)) if y >= 0]
    df = spark.createDataFrame(rows, ["k", "label", "features"]).repartition(FIT_PARTITIONS, "k").sortWithinPartitions("k").cache()
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.2, seed=7, subsamplingRate=0.8).fit(df)
    df.unpersist()
    trees = [_flatten(t._call_java("rootNode")) for t in model.trees]
    return Trees(trees, list(model.treeWeights), weight)


def fit_model(df: DataFrame, id: str, text: str, bound: int = SAMPLE) -> Trees | None:
    several = df.where(F.col(text).contains("\n"))
    return fit(df.sparkSession, [r[1] for r in bounded_sample(several, id, bound, text)])


def decode(n: Nodes, margin: np.ndarray) -> np.ndarray:
    """Whether each line is page: from the lines up, every section and block takes the best of all page, all text and mixed; then down."""
    margin = np.where(n.begins, np.minimum(margin, -1.0), margin)  # an article or item is text
    first = np.unique(n.section, return_index=True)[1]
    above = n.block[first]  # the block of each section
    page_s = np.bincount(n.section, margin)
    mixed_s = np.bincount(n.section, np.maximum(margin, 0)) - MIXED
    best_s = np.maximum(np.maximum(page_s, 0), mixed_s)
    page_b = np.bincount(above, page_s)
    mixed_b = np.bincount(above, best_s) - MIXED
    uniform_b = mixed_b <= np.maximum(page_b, 0)
    line = np.where((mixed_s > np.maximum(page_s, 0))[n.section], margin > 0, (page_s > 0)[n.section])
    return np.where(uniform_b[n.block], (page_b > 0)[n.block], line)


def find(model: Trees | None, texts: list[str | None]) -> list[list[int]]:
    """Line numbers of the page's lines, per text; all texts of a batch go through the trees at once."""
    out: list[list[int]] = [[] for _ in texts]
    parts = [(i, *x) for i, t in enumerate(texts) if t and (x := strip_lines(t))[1]] if model else []
    if not parts:
        return out
    n = nodes([lines for _, _, lines in parts], model.weight)
    numbers = [(i, k) for i, ks, _ in parts for k in ks]
    for j in np.flatnonzero(decode(n, model.margin(n.x))):
        i, k = numbers[j]
        out[i].append(k)
    return out


def page_lines(df: DataFrame, id: str, text: str, model: Trees | None = None) -> DataFrame:
    """(id, line_no) of every line that belongs to the page.  Repeated ids give their lines once."""
    model = model or fit_model(df, id, text)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = find(shared.value, b.column(1).to_pylist())
            n = [len(h) for h in hits]
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(n)), n)))
            yield pa.RecordBatch.from_arrays([ids, pa.array([x for h in hits for x in h], pa.int32())], names=[id, "line_no"])

    schema = StructType([df.schema[id], StructField("line_no", IntegerType())])
    return df.select(id, text).mapInArrow(run, schema).distinct()


def main_text(df: DataFrame, id: str, text: str, model: Trees | None = None) -> DataFrame:
    """(id, text) with the page's lines removed; texts without any pass unchanged."""
    model = model or fit_model(df, id, text)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            kept = []
            for t, h in zip(texts, find(shared.value, texts), strict=True):
                gone = set(h)
                kept.append("\n".join(s for i, s in enumerate(t.split("\n"), 1) if i not in gone) if gone else t)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.string())], names=[id, text])

    return df.select(id, text).mapInArrow(run, StructType([df.schema[id], StructField(text, StringType())]))

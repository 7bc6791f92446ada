"""Problem 5: one consistent form for text that looks the same but differs in its characters.

Method: compatibility normalisation in composed form, full case folding, mapped white space and
removal of default-ignorable characters, computed once per distinct value of a batch.  The folded
form is the candidate key of a comparison; the *visible* form is stricter (letter case, raised and
circled digits stay apart) and is the exact check that follows.

Nulls stay null, empty strings stay empty.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from lawweave.llm.common import char_class
from lawweave.session import cut

# Letters of other scripts that are drawn like Latin letters.
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХѕіјаеорсухһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανιрӏ",
        "ABESIJKMHOPCTYXsijaeopcyxhdqwABEZHIKMNOPTYXoavipl",
        strict=True,
    )
)
# Radicals without a compatibility mapping, and the character each is drawn like.
RADICALS = {"⺀": "冫", "⺁": "厂", "⺅": "亻", "⺉": "刂", "⺋": "㔾", "⺍": "⺌", "⺗": "㣺", "⺘": "扌", "⺙": "攵", "⺡": "氵", "⺣": "灬", "⺤": "爫", "⺨": "犭", "⺩": "王", "⺭": "礻", "⺮": "竹", "⺶": "羊", "⺷": "羊", "⺼": "月", "⺾": "艹", "⺿": "艹", "⻀": "艹", "⻁": "虎", "⻂": "衤", "⻃": "覀", "⻄": "西", "⻅": "见", "⻆": "角", "⻈": "讠", "⻉": "贝", "⻋": "车", "⻌": "辶", "⻍": "辶", "⻎": "辶", "⻏": "阝", "⻐": "钅", "⻑": "長", "⻒": "镸", "⻓": "长", "⻔": "门", "⻖": "阝", "⻗": "雨", "⻘": "青", "⻙": "韦", "⻚": "页", "⻛": "风", "⻜": "飞", "⻝": "食", "⻟": "飠", "⻠": "饣", "⻢": "马", "⻣": "骨", "⻤": "鬼", "⻥": "鱼", "⻦": "鸟", "⻧": "卤", "⻨": "麦", "⻩": "黄", "⻫": "斉", "⻬": "齐", "⻮": "齿", "⻰": "龙"}
# Code points of the Unicode property Default_Ignorable_Code_Point.
IGNORABLE = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF)]
# Signs whose compatibility form is another sign to the eye.
RAISED = ("<super>", "<sub>", "<circle>", "<square>", "<fraction>")

#: A spelling with more rows is dealt over several tasks.
HOT_ROWS = 10_000

_PRIVATE = 0xF0000
_TRAIL = re.compile(r" +(?=\n|\Z)")
_PRIVATE_SIGN = re.compile("[\U000f0000-\U000fffff]")


@lru_cache(maxsize=None)
def _table() -> dict[int, str | None]:
    """What single code points become before normalisation; raised and circled signs become private signs."""
    t: dict[int, str | None] = {}
    for o in range(0x80, 0xFFFE):
        d = unicodedata.decomposition(chr(o))
        if d.startswith(RAISED) or (d.startswith("<compat>") and "0028" in d.split()):
            t[o] = chr(_PRIVATE + o)
    t |= {ord(a): b for a, b in (LOOKALIKES | RADICALS).items()}
    t |= {o: None for a, b in IGNORABLE for o in range(a, b + 1)}
    t |= {o: None for o in [*range(0x20), 0x7F] if chr(o) not in "\t\n\x0b\x0c"}
    t |= {o: " " for o in (9, 11, 12, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}
    return t


def _whole(s: str) -> str:
    """Normalise, map, normalise and map again (a composition may have made a further look-alike)."""
    for _ in range(2):
        s = unicodedata.normalize("NFKC", unicodedata.normalize("NFC", s).translate(_table()))
    return s


@lru_cache(maxsize=None)
def _fast() -> tuple[re.Pattern, re.Pattern, dict[str, str]]:
    """For text whose signs do not combine, normalisation works sign by sign: which signs change, and into what."""
    change = {c: w for o in range(0xFFFE) if not 0xD800 <= o < 0xE000 and (w := _whole(c := chr(o))) != c}
    joins = char_class(lambda c: c > "\uffff" or unicodedata.combining(unicodedata.normalize("NFKC", c)[0]) > 0 or unicodedata.category(c)[0] == "M" or "\u1100" <= c <= "\u11ff" or "\ud7b0" <= c <= "\ud7ff" or "\uffa0" <= c <= "\uffdc")
    return re.compile(f"[{joins}]"), re.compile("[" + "".join(map(re.escape, change)) + "]"), change


def visible(s: str) -> str:
    """What a reader sees: as ``folded``, but letter case and raised or circled signs stay apart."""
    joins, changes, change = _fast()
    s = _whole(s) if joins.search(s) else changes.sub(lambda m: change[m[0]], s)
    return _TRAIL.sub("", s)


def folded(s: str, seen: str | None = None) -> str:
    """The consistent form: composed compatibility form, fully case folded, without invisible signs.

    ``seen`` is the visible form, where the caller has it already.
    """
    seen = visible(s) if seen is None else seen
    if _PRIVATE_SIGN.search(seen):
        seen = _PRIVATE_SIGN.sub(lambda m: unicodedata.normalize("NFKC", chr(ord(m[0]) - _PRIVATE)), seen)
    return unicodedata.normalize("NFC", seen.casefold())


def _per_distinct(values: pd.Series, f) -> pd.Series:
    codes, uniques = pd.factorize(values)
    done = pd.Series([f(u) for u in uniques], dtype=object)
    return pd.Series([None if c < 0 else done[c] for c in codes], dtype=object)


@pandas_udf(StringType())
def unify(values: pd.Series) -> pd.Series:
    """Column function: the consistent form of each value; null stays null."""
    return _per_distinct(values, folded)


@pandas_udf(StructType([StructField(x, BinaryType()) for x in ("folded", "seen", "raw")]))
def _keys(title: pd.Series, text: pd.Series) -> pd.DataFrame:
    def dig(a: str, b: str) -> bytes:
        return hashlib.blake2b(f"{len(a)}:{a}{b}".encode("utf-8", "surrogatepass"), digest_size=16).digest()

    def forms(values: pd.Series) -> dict[str, tuple[str, str]]:
        """Both forms of each distinct value of the batch."""
        return {x: (folded(x, v := visible(x)), v) for x in values.unique()}

    titles, texts = forms(title), forms(text)
    out = []
    for a, b in zip(title, text, strict=True):
        (fa, va), (fb, vb) = titles[a], texts[b]
        out.append((dig(fa, fb), dig(va, vb), dig(a, b)))
    return pd.DataFrame(out, columns=["folded", "seen", "raw"])


def unify_columns(df: DataFrame, *columns: str, suffix: str = "_unified") -> DataFrame:
    """``df`` with the consistent form of each named column beside it."""
    return df.select("*", *(unify(F.col(c)).alias(c + suffix) for c in columns))


def spellings(df: DataFrame, id: str, title: str, text: str) -> DataFrame:
    """(id, folded, seen, raw): the digests of each row's consistent form, visible form and characters, once per row.

    Rows with a null title or id, or a null or empty text, are left out; repeated ids count once.  The digests are
    written once and read by all that follows.
    """
    good = F.col(title).isNotNull() & F.col(text).isNotNull() & (F.col(text) != "") & F.col(id).isNotNull()
    return cut(df.where(good).select(F.col(id).alias("id"), _keys(F.col(title), F.col(text)).alias("k")).select("id", "k.*").distinct())


def look_alike_classes(df: DataFrame, id: str, title: str, text: str) -> DataFrame:
    """(id, class, spelling, spellings) of every row that looks like another one of other characters.

    One row per row of ``df``, however many look alike: a class is what looks the same, a spelling what is the same.
    """
    k = spellings(df, id, title, text)
    several = k.select("folded", "seen", "raw").distinct().groupBy("folded", "seen").agg(F.count("*").cast("int").alias("spellings")).where("spellings > 1")
    return k.join(several, ["folded", "seen"]).select(F.col("id").alias(id), F.hex("seen").alias("class"), F.hex("raw").alias("spelling"), "spellings")


def look_alike_pairs(df: DataFrame, id: str, title: str, text: str, hot: int = HOT_ROWS) -> DataFrame:
    """Pairs (a < b) of rows whose title and text look the same but are not the same characters.

    Only digests are shuffled.  The distinct spellings of a group are paired first and their rows joined
    to the pairs, so that only rows of different spellings meet; a spelling of more than ``hot`` rows is
    salted by the id, and the other side of its pairs repeated per salt.
    """
    k = spellings(df, id, title, text)
    own = k.groupBy("folded", "seen", "raw").agg(F.ceil(F.count("*") / hot).cast("int").alias("salts"))
    several = own.groupBy("folded", "seen").count().where("count > 1").select("folded", "seen")
    own = cut(own.join(several, ["folded", "seen"], "left_semi"))  # few: those of look-alikes
    a, b = (own.select(*(F.col(c).alias(c + s) for c in own.columns)) for s in "ab")
    pairs = a.join(b, (F.col("foldeda") == F.col("foldedb")) & (F.col("seena") == F.col("seenb")) & (F.col("rawa") < F.col("rawb")))
    # Both sides of each pair of spellings, once per salt of the side's own; joined with the rows of the spelling.
    sides = pairs.select("rawa", "rawb", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col("raw" + s).alias("raw"), F.col("salts" + s).alias("own"), F.col("salts" + o).alias("other")) for s, o in ("ab", "ba")))).alias("s"))
    sides = sides.select("rawa", "rawb", "s.*").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("own") - 1))).drop("own")
    salted = own.where("salts > 1").select("raw", "salts")
    rows = k.join(F.broadcast(salted), "raw", "left")  # at most one row per ``hot`` rows of the table
    rows = rows.select("id", "raw", F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    met = cut(rows.join(sides, ["raw", "salt"]).withColumn("there", F.explode(F.sequence(F.lit(0), F.col("other") - 1))).drop("other", "raw"))
    left = met.where("side = 'a'").select("rawa", "rawb", F.col("salt").alias("i"), F.col("there").alias("j"), F.col("id").alias("ida"))
    right = met.where("side = 'b'").select("rawa", "rawb", F.col("there").alias("i"), F.col("salt").alias("j"), F.col("id").alias("idb"))
    hit = left.join(right, ["rawa", "rawb", "i", "j"]).where(F.col("ida") != F.col("idb"))
    return hit.select(F.least("ida", "idb").alias(f"{id}_a"), F.greatest("ida", "idb").alias(f"{id}_b")).distinct()

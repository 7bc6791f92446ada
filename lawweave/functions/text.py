"""Column functions on text.  All are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

import html.entities
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, for Java's regex; its own ``\\s`` is ASCII only.
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The signs numerals of articles are written with.
NUMERALS = "一二三四五六七八九十百千万零〇两0-9"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` evaluated once, however often ``f`` uses it: bound as the variable of a lambda."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def quoted(s: str) -> str:
    """``s`` as a literal of Java's regex."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def clean_text(c: Column, nbsp: bool = False) -> Column:
    """Line ends as ``\\n``, runs of space, tab and U+3000 (``nbsp``: also U+00A0) as one space, at most one blank line in a row; null stays null."""
    c = F.regexp_replace(c, "\r\n?", "\n")
    c = F.regexp_replace(c, "[ \t　\u00a0]+" if nbsp else "[ \t　]+", " ")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


# The named entities of HTML, from Python's table; those that also count without a semicolon; and what the numbers
# 128 to 159 mean on the web.
NAMED = {k[:-1]: v for k, v in html.entities.html5.items() if k.endswith(";")}
BARE = sorted((k for k in html.entities.html5 if not k.endswith(";")), key=len, reverse=True)
WEB_NUMBERS = {i: c for i in range(128, 160) if (c := bytes([i]).decode("cp1252", "replace")) != "\ufffd"}


def unescape(c: Column) -> Column:
    """HTML entities resolved, named and numeric; one pass, so nothing is resolved twice.

    Built-in expressions only: the text is cut at each ampersand, and what follows one is looked up.  A name that
    is not known, or a number that names no character, stays or becomes U+FFFD as browsers have it.
    """
    # Each table is one literal that Spark folds into a map while it plans.
    names = F.str_to_map(F.lit("\u0002".join(f"{k}\u0001{v}" for k, v in NAMED.items())), F.lit("\u0002"), F.lit("\u0001"))
    web = F.str_to_map(F.lit("\u0002".join(f"{k}\u0001{v}" for k, v in WEB_NUMBERS.items())), F.lit("\u0002"), F.lit("\u0001"))
    bare = "^(" + "|".join(map(re.escape, BARE)) + ")"

    def sign(code: Column) -> Column:
        known = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        bad = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        return F.when(bad, F.lit("\ufffd")).otherwise(F.coalesce(web[code.cast("string")], known))

    def one(part: Column) -> Column:
        digits = F.regexp_extract(part, "^#([0-9]+);?", 1)
        hexes = F.regexp_extract(part, "^#[xX]([0-9a-fA-F]+);?", 1)
        name = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*);", 1)
        short = F.regexp_extract(part, bare, 1)
        full = names[name]
        return (
            F.when(digits != "", F.concat(sign(F.when(F.length(digits) < 10, digits.cast("long"))), F.regexp_replace(part, "^#[0-9]+;?", "")))
            .when(hexes != "", F.concat(sign(F.when(F.length(hexes) < 9, F.conv(hexes, 16, 10).cast("long"))), F.regexp_replace(part, "^#[xX][0-9a-fA-F]+;?", "")))
            .when(full.isNotNull(), F.concat(full, F.substring(part, F.length(name) + 2, F.length(part))))
            .when(short != "", F.concat(names[short], F.substring(part, F.length(short) + 1, F.length(part))))
            .otherwise(F.concat(F.lit("&"), part))
        )

    parts = F.split(c, "&")
    resolved = F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), ""))
    return F.when(F.contains(c, F.lit("&")), resolved).otherwise(c)


def clean_space(c: Column, breaks: bool = False, trim_lines: bool = True, entities: bool = True) -> Column:
    """Space as the crawlers clean it: optional ``<br>`` as line end, entities, one space per run, lines trimmed at their start."""
    if breaks:
        c = F.regexp_replace(c, r"(?i)<br\s*/?>", "\n")
    if entities:
        c = unescape(c)
    c = F.regexp_replace(c, r"[\t\r\f\x0b]+", " ")
    c = F.regexp_replace(c, "[ 　]+", " ")
    if trim_lines:
        c = F.regexp_replace(c, "\n[ 　]+", "\n")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def truthy(*columns: Column) -> Column:
    """The first value that is neither null nor an empty string; null if there is none."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def first_line(c: Column, bad_prefixes: Sequence[str] = (), limit: int = 160) -> Column:
    """The first non-blank line that does not begin with a bad prefix, cut to ``limit`` signs; empty if there is none."""
    lines = F.filter(F.transform(F.split(c, r"\r\n|\r|\n"), strip), lambda x: x != "")
    if bad_prefixes:
        bad = "^(" + "|".join(map(quoted, bad_prefixes)) + ")"
        lines = F.filter(lines, lambda x: ~x.rlike(bad))
    return F.when(c.isNotNull(), F.coalesce(F.substring(F.get(lines, 0), 1, limit), F.lit("")))


# A date of this century, with the months and days a calendar can have; the loose one of imported files.
DATE = r"(20[0-9]{2})[-年./](0?[1-9]|1[0-2])[-月./](3[01]|[12][0-9]|0?[1-9])"
LOOSE_DATE = r"(20[0-9]{2})\s*(?:年|-|/)\s*([0-9]{1,2})\s*(?:月|-|/)\s*([0-9]{1,2})\s*(?:日)?"
EFFECTIVE = rf"自\s*({LOOSE_DATE})\s*(?:起|实施|施行)"


def _padded(c: Column, p: str) -> Column:
    return F.when(c.rlike(p), F.concat_ws("-", F.regexp_extract(c, p, 1), *(F.lpad(F.regexp_extract(c, p, i), 2, "0") for i in (2, 3))))


def extract_date(c: Column) -> Column:
    """The first ``20yy-m-d`` (also with ``年月日``, dots or slashes) as ``yyyy-mm-dd``; null if there is none."""
    return _padded(c, DATE)


def parse_date(c: Column) -> Column:
    """``extract_date``, else the first ten signs of the value; null for an empty one."""
    return F.coalesce(extract_date(c), F.nullif(F.substring(c, 1, 10), F.lit("")))


def date_or_raw(c: Column) -> Column:
    """``extract_date``, else the value as it is; null for an empty one."""
    return F.coalesce(extract_date(c), F.nullif(c, F.lit("")))


def valid_date(c: Column) -> Column:
    """The extracted date as DATE; null if the calendar has no such day."""
    return F.try_to_date(extract_date(c), "yyyy-MM-dd")


def loose_date(c: Column) -> Column:
    """The first date that may hold spaces, as ``yyyy-mm-dd``; null if the calendar has no such day."""
    return F.date_format(F.try_to_date(_padded(c, LOOSE_DATE), "yyyy-MM-dd"), "yyyy-MM-dd")


def labelled_date(c: Column, label: str) -> Column:
    """The date behind ``【label】``; null if there is none."""
    found = F.regexp_extract(c, rf"【{quoted(label)}】\s*(20[0-9]{{2}}[-/年.][0-9]{{1,2}}[-/月.][0-9]{{1,2}})", 1)
    return parse_date(found)


def inferred_dates(c: Column, head: int = 1500) -> Column:
    """(published_at, effective_at) from a text's beginning: the first date, and the one it takes effect from.

    A text that takes effect on its publication has that day; null where there is none.
    """
    h = F.substring(c, 1, head)
    published = loose_date(h)
    effective = F.coalesce(loose_date(F.regexp_extract(h, EFFECTIVE, 1)), F.when(F.contains(h, F.lit("自发布之日起")), published))
    return F.struct(published.alias("published_at"), effective.alias("effective_at"))


def numbered_title(name: Column, text: Column, rule: str = "(法|办法|规则|细则|指引|指南|规范|风险揭示书)") -> Column:
    """(title, source_key) of an imported file: its first line where that names a rule, else the title in its name.

    Names are ``number_source_x_title`` or ``number_CSRC_NERIS_x_title``; any other name is the title, its source null.
    """
    parts = F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "_")
    long_key = (F.size(parts) >= 5) & (F.get(parts, 1) == "CSRC") & (F.get(parts, 2) == "NERIS")
    numbered = (F.size(parts) >= 4) & F.get(parts, 0).rlike("^[0-9]+$")
    named = F.when(numbered, strip(F.array_join(F.when(long_key, F.slice(parts, 5, F.size(parts))).otherwise(F.slice(parts, 4, F.size(parts))), "_"))).otherwise(F.array_join(parts, "_"))
    line = F.get(F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), strip), lambda x: x != ""), 0)
    good = F.coalesce((F.length(line) <= 80) & ~line.rlike(r"^[（(【]") & line.rlike(rule) & ~F.contains(line, F.lit("发布")), F.lit(False))
    key = F.when(numbered, F.when(long_key, F.lit("CSRC_NERIS")).otherwise(F.get(parts, 1)))
    return F.struct(F.when(good, line).otherwise(named).alias("title"), key.alias("source_key"))


def fixed(c: Column, digits: int = 2) -> Column:
    """A number with so many digits after the point, without signs between thousands."""
    return F.format_string(f"%.{digits}f", c)


def millis_to_date(c: Column, zone: str = "Asia/Shanghai") -> Column:
    """Epoch milliseconds as a date of ``zone``."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_millis(c), zone))


def short_id(prefix: Column, key: Column) -> Column:
    """A deterministic id: the prefix and the first twelve digits of the key's SHA-1."""
    return F.concat_ws("_", prefix, F.substring(F.sha1(key), 1, 12))


def occurrences(c: Column, term: str) -> Column:
    """Non-overlapping occurrences of a non-empty term."""
    if not term:
        raise ValueError("an empty term occurs everywhere")
    return ((F.length(c) - F.length(F.replace(c, F.lit(term), F.lit("")))) / len(term)).cast("int")


def keyword_score(c: Column, terms: Sequence[str]) -> Column:
    """Sum over the terms of occurrences times length, without regard to case; 0 for null."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return sum((occurrences(low, t.lower()) * max(1, len(t)) for t in terms if t), F.lit(0))


def preview(c: Column, terms: Sequence[str], width: int = 240, before: int = 80) -> Column:
    """The text around the first of the terms, line ends as spaces; empty for null."""
    low = F.lower(c)
    found = F.array_min(F.filter(F.array(*(F.instr(low, t.lower()) for t in terms)), lambda x: x > 0))
    start = F.greatest(F.lit(0), F.coalesce(found, F.lit(1)) - 1 - before)
    return F.coalesce(F.translate(F.substring(c, start + 1, F.lit(width)), "\n", " "), F.lit(""))


def shorten(c: Column, limit: int) -> Column:
    """Cut to ``limit`` signs, with an ellipsis where something was cut."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("…"))).otherwise(c)


def contains_any(c: Column, terms: Sequence[str]) -> Column:
    """Whether any of the terms occurs; false for null or without terms."""
    return F.coalesce(c.rlike("|".join(map(quoted, terms))), F.lit(False)) if terms else F.lit(False)


def any_keyword(c: Column, keywords: Column) -> Column:
    """Whether the text holds one of the row's keywords; true if the list is empty or null, false for a null text."""
    none = F.coalesce(F.size(keywords) <= 0, F.lit(True))
    return none | F.coalesce(F.exists(keywords, lambda k: (k != "") & F.contains(c, k)), F.lit(False))


def percent_encoded(c: Column, safe: str) -> Column:
    """Every sign but letters, digits, ``_.-~`` and the ``safe`` ones as the bytes of its UTF-8; null stays null."""
    plain = f"[A-Za-z0-9_.~{re.escape(safe)}-]"
    signs = F.transform(F.split(c, "(?!^)(?=.)(?<![\\ud800-\\udbff])"), lambda x: F.when(x.rlike(f"^{plain}*$"), x).otherwise(F.regexp_replace(F.hex(F.encode(x, "UTF-8")), "(..)", "%$1")))
    return F.when(c.rlike(f"^{plain}*$"), c).otherwise(F.array_join(signs, ""))


def url_parts(url: Column) -> Column:
    """(scheme, netloc, path, query, fragment) as they stand, each with its own signs; empty where missing."""
    p = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
    return F.struct(*(F.regexp_extract(url, p, i).alias(n) for i, n in enumerate(("scheme", "netloc", "path", "query", "fragment"), 1)))


def ascii_url(url: Column) -> Column:
    """A URL as found on a page, with path, query and fragment percent-encoded; what is encoded already stays."""
    u = url_parts(url)
    tail = "=&%:/?+@,;"
    rest = (F.when(F.length(u[x]) > 1, F.concat(F.substring(u[x], 1, 1), percent_encoded(F.substring(u[x], 2, F.length(u[x])), tail))).otherwise(F.lit("")) for x in ("query", "fragment"))
    return F.concat(u["scheme"], u["netloc"], percent_encoded(u["path"], "/%:@"), *rest)


def url_candidates(url: Column, host_of: str, other: str) -> Column:
    """The URL, and the same on another host where it is on ``host_of``."""
    u = url_parts(url)
    moved = F.concat(u["scheme"], F.lit(f"//{other}"), u["path"], u["query"])
    return F.when(u["netloc"] == f"//{host_of}", F.array(url, moved)).otherwise(F.array(url))


def host(url: Column) -> Column:
    """The host of a URL in lower case; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def domain_allowed(url: Column, domains: Column) -> Column:
    """Whether the URL's host is one of the domains or below one; false without a host."""
    h = host(url)
    return F.coalesce(F.exists(domains, lambda d: (h == F.lower(d)) | h.endswith(F.concat(F.lit("."), F.lower(d)))), F.lit(False))


def suffix(path: Column) -> Column:
    """The file suffix with its dot, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(path, r"(\.[^./?#]+)(?:[?#].*)?$", 1))


def article_no(c: Column) -> Column:
    """The article number a text begins with; empty if there is none."""
    return F.regexp_extract(c, f"^(第[{NUMERALS}]+条)", 1)


def bare_article_no(c: Column) -> Column:
    """An article number without its frame."""
    return F.regexp_replace(F.regexp_replace(c, "^第", ""), "条$", "")


def json_object(c: Column) -> Column:
    """The outermost JSON object of a text that may be fenced or surrounded by prose; null if there is none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(c, "```(?:json)?", ""), r"(?s)(\{.*\})", 1), F.lit(""))


def unwrapped(c: Column) -> Column:
    """What stands between the first opening and the last closing bracket, as in a response wrapped for a script."""
    return F.nullif(F.regexp_extract(c, r"(?s)^[^(]*\((.*)\)[^)]*$", 1), F.lit(""))


def round_half_up(c: Column, digits: int = 2) -> Column:
    """Half up on the binary value, as floor(x * 10^d + 0.5) / 10^d."""
    k = 10.0**digits
    return F.floor(c * k + 0.5) / k

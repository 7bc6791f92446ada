"""Column functions on nested payloads: laws with entries and items, item paths, trees of headings."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from lawweave.functions.text import clean_space

# The fields of a law's payload that are read.
LAW = "struct<lawlist: struct<law: struct<wtAnttnSecFutrsLawName: string, bodyAgoCntnt: string, bodyAftCntnt: string, draftDscr: string>, lawEntryVOs: array<struct<title: string, cntnt: string, itemList: array<struct<cntnt: string>>>>>>"


def plain(c: Column) -> Column:
    """A piece of HTML as text: tags gone, space cleaned, null as empty."""
    return clean_space(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", ""), breaks=True)


def law_text(payload: Column) -> Column:
    """The text of a law's payload (``LAW``): what stands before, its entries with their items, what stands after, by blank lines.

    An entry's title and content are one line; an entry without both, or an item without content, gives none.
    """
    law, entries = payload["lawlist"]["law"], payload["lawlist"]["lawEntryVOs"]

    def of(e: Column) -> Column:
        head = F.array(clean_space(F.concat_ws(" ", plain(e["title"]), plain(e["cntnt"]))))
        return F.concat(head, F.transform(F.coalesce(e["itemList"], F.array().cast("array<struct<cntnt: string>>")), lambda i: plain(i["cntnt"])))

    body = F.coalesce(F.flatten(F.transform(entries, of)), F.array().cast("array<string>"))
    lines = F.concat(F.array(plain(law["wtAnttnSecFutrsLawName"]), plain(law["bodyAgoCntnt"])), body, F.array(plain(law["bodyAftCntnt"]), plain(law["draftDscr"])))
    return clean_space(F.array_join(F.filter(lines, lambda x: x != ""), "\n\n"), entities=False)


def item_paths(paths: Column) -> Column:
    """``array<struct<ItemLvs: array<struct<itemName: string>>>>`` as an array of names joined by `` / ``; empty paths drop out."""
    names = F.transform(F.coalesce(paths, F.array().cast("array<struct<ItemLvs: array<struct<itemName: string>>>>")), lambda p: F.filter(F.transform(p["ItemLvs"], lambda n: n["itemName"]), lambda x: F.coalesce(x, F.lit("")) != ""))
    return F.transform(F.filter(names, lambda x: F.size(x) > 0), lambda x: F.array_join(x, " / "))


@pandas_udf(StringType())
def heading_tree(payload: pd.Series) -> pd.Series:
    """A tree ``{title, children}`` of any depth, as JSON, as lines indented by two spaces a level; null stays null.

    Depth is not bounded, which no column type has, so the tree is walked here, with a stack.
    """

    def lines(doc: str | None) -> str | None:
        if doc is None:
            return None
        out, todo = [], [(json.loads(doc), 0)]
        while todo:
            node, depth = todo.pop()
            if node:
                if node.get("title"):
                    out.append("  " * depth + node["title"])
                todo += [(child, depth + 1) for child in reversed(node.get("children") or [])]
        return "\n".join(out)

    return payload.map(lines)

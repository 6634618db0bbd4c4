"""Links inside a cell: HTML anchors and hyperlink formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An anchor's opening tag with a target that is quoted either way or bare. Quoted values
# are passed over whole, and an attribute's name starts after a blank. Possessive, so linear.
ATTRIBUTE = r"""[^\s=<>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s<>"']++))?+"""
OPENING = rf"""<a(?=[\s/])(?:[\s/]++(?!href\s*+=){ATTRIBUTE})*+[\s/]++href\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s<>"']++))(?:[\s/]++(?:{ATTRIBUTE})?+)*+>"""
# The text ends at the closing tag or, where that is missing, before the next anchor opens: no link then.
ANCHOR = rf"{OPENING}((?:[^<]++|<(?!/?a[\s>/]))*+)</a\s*+>"
# A hyperlink formula with one or two texts; a doubled quote stands for a quote.
TEXT = r'"([^"]*+(?:""[^"]*+)*+)"'
FORMULA = rf"=\s*+HYPERLINK\s*+\(\s*+{TEXT}\s*+(?:[,;]\s*+{TEXT}\s*+)?+\)"
LINK = f"(?is){ANCHOR}|{FORMULA}"
# Entities that targets hold; fixed values.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": '"', "&#39;": "'", "&apos;": "'", "&#38;": "&", "&amp;": "&"}


def link_matches(cell: Column) -> Column:
    """Every link of the cell as written, in order of appearance."""
    return F.regexp_extract_all(cell, F.lit(LINK), F.lit(0))


def link_uri(match: Column) -> Column:
    """Target of a link: entities of an anchor are decoded, doubled quotes of a formula are single."""
    anchor = F.concat(*[F.regexp_extract(match, LINK, group) for group in (1, 2, 3)])
    for entity, character in ENTITIES.items():
        anchor = F.replace(anchor, F.lit(entity), F.lit(character))
    return F.concat(anchor, _formula_text(match, 5))


def link_text(match: Column) -> Column:
    """Text of a link as written between its tags; a formula without one shows its target."""
    shown = F.coalesce(F.nullif(_formula_text(match, 6), F.lit("")), _formula_text(match, 5))
    return F.concat(F.regexp_extract(match, LINK, 4), shown)


def _formula_text(match: Column, group: int) -> Column:
    return F.replace(F.regexp_extract(match, LINK, group), F.lit('""'), F.lit('"'))

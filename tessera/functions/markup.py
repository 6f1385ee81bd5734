"""Markup in dialogue scripts, notes and wiki text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import strip


def icon(line: Column) -> Column:
    """Number of the first \\I[n]; null if there is none."""
    return F.regexp_extract(line, r"\\I\[(\d+)\]", 1).try_cast("int")


def without_icons(line: Column) -> Column:
    return F.regexp_replace(line, r"\\I\[\d+\]", "")


def keywords(body: Column) -> Column:
    """Texts of coloured spans, tags inside them removed; repeats stay."""
    spans = F.regexp_extract_all(body, F.lit(r"(?s)\\C\[0*[1-9]\d*\](.*?)\\C\[0\]"), F.lit(1))
    return F.filter(F.transform(spans, lambda x: strip(without_colours(x))), lambda x: x != "")


def without_colours(body: Column) -> Column:
    return F.regexp_replace(body, r"\\C\[\d+\]", "")


BRACKET = r"\[([^\]:]+):\s*([^\]]+)\]"


def bracket_pairs(text: Column) -> Column:
    """[Key: Value] as structs (key, value, pos); keys in lower case with underscores; all occurrences."""
    keys, values = (F.regexp_extract_all(text, F.lit(BRACKET), F.lit(i)) for i in (1, 2))
    return F.zip_with(
        F.transform(keys, lambda k, i: F.struct(F.replace(F.lower(strip(k)), F.lit(" "), F.lit("_")).alias("key"), i.alias("pos"))),
        values,
        lambda k, v: F.struct(k["key"].alias("key"), strip(v).alias("value"), k["pos"].alias("pos")),
    )


def bracket_map(text: Column) -> Column:
    """The pairs as a map in order of first occurrence; the last value of a key counts."""
    pairs = bracket_pairs(text)
    names = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    return F.map_from_entries(F.transform(names, lambda k: F.struct(k, F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"])))


def without_brackets(text: Column) -> Column:
    return strip(F.regexp_replace(text, BRACKET, ""))


#: Tags whose whole content is not part of a page's text.
CHROME = ("script", "style", "nav", "header", "footer", "aside")


def main_text(html: Column, max_chars: int = 20_000) -> Column:
    """A page's text without its chrome, by patterns alone: no nesting of equal tags, no entities, no class rule."""
    s = F.regexp_replace(html, r"(?is)<(" + "|".join(CHROME) + r")\b.*?</\1>", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    return F.substring(strip(F.regexp_replace(s, r"\s+", " ")), 1, max_chars)


def cell(value: Column, null_text: str = "None") -> Column:
    """One cell of a Markdown table; pipes stay as they are."""
    return strip(F.replace(F.coalesce(value.cast("string"), F.lit(null_text)), F.lit("\n"), F.lit(" ")))

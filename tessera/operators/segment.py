"""Splitting text into chunks, sections and blocks: folds over one document, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import markup as M
from tessera.functions import strings as S

TEXTS = "array<string>"


def _empty() -> Column:
    return F.array().cast(TEXTS)


def _joined_length(xs: Column, gap: int) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + F.length(x)) + gap * F.greatest(F.size(xs) - 1, F.lit(0))


def paragraph_chunks(text: Column, limit: int = 8000, overlap: int = 1, delimiter: str = "\n\n", whole: bool = False) -> Column:
    """Paragraphs packed into chunks of at most `limit` characters, separators counted.

    A paragraph is trimmed and clamped to the limit, or goes on in further pieces of it if
    `whole`; empty ones go. A full chunk is sealed, and the next begins with as many of its
    last `overlap` paragraphs as fit before the new one.
    """
    gap = len(delimiter)
    parts = F.filter(F.transform(F.split(text, _literal(delimiter)), S.strip), lambda p: p != "")
    parts = _pieces(parts, limit) if whole else F.transform(parts, lambda p: F.substring(p, 1, limit))
    start = F.struct(_empty().alias("done"), _empty().alias("cur"), F.lit(0).alias("n"))

    def add(s: Column, p: Column) -> Column:
        full = (F.size(s["cur"]) > 0) & (s["n"] + gap + F.length(p) > limit)
        tail = _empty()
        for k in range(1, overlap + 1):  # the longest tail that fits is taken
            last = F.slice(s["cur"], -k, k)
            tail = F.when((F.size(s["cur"]) >= k) & (_joined_length(last, gap) + gap + F.length(p) <= limit), last).otherwise(tail)
        begun = F.concat(tail, F.array(p))
        sealed = F.struct(F.concat(s["done"], F.array(F.array_join(s["cur"], delimiter))).alias("done"), begun.alias("cur"), _joined_length(begun, gap).alias("n"))
        grown = F.struct(s["done"].alias("done"), F.concat(s["cur"], F.array(p)).alias("cur"), (s["n"] + F.when(F.size(s["cur"]) > 0, gap).otherwise(0) + F.length(p)).alias("n"))
        return F.when(full, sealed).otherwise(grown)

    finish = lambda s: F.when(F.size(s["cur"]) > 0, F.concat(s["done"], F.array(F.array_join(s["cur"], delimiter)))).otherwise(s["done"])
    return F.aggregate(parts, start, add, finish)


def _pieces(parts: Column, limit: int) -> Column:
    """Each part in pieces of `limit` characters, the last one shorter; blank ones go. A piece of `limit` fills a chunk, so pieces of one part never meet in one."""
    # Possessive: a text is gone through once, without a call for each change between characters of one and two UTF-16 units.
    cut = lambda p: F.regexp_extract_all(p, F.lit(f"(?s).{{1,{limit}}}+"), F.lit(0))
    return F.filter(F.flatten(F.transform(parts, cut)), lambda p: p.rlike(r"(?U)\S"))


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def _packed(items: Column, limit: int, joiner: str, extra: int, at_end: bool) -> Column:
    """Items packed in order. A pack is sealed when its count would pass the limit.

    extra: counted besides an item's length; at_end: already in the test, not only afterwards.
    A pack's first item counts its length alone, or with `extra` if it is the very first.
    """
    start = F.struct(_empty().alias("done"), _empty().alias("cur"), F.lit(0).alias("n"))

    def add(s: Column, x: Column) -> Column:
        length = F.length(x)
        full = (s["n"] + length + (extra if at_end else 0) > limit) & (F.size(s["cur"]) > 0)
        restart = s["n"] + length + (extra if at_end else 0) > limit
        sealed = F.struct(F.concat(s["done"], F.array(F.array_join(s["cur"], joiner))).alias("done"), F.array(x).alias("cur"), length.alias("n"))
        fresh = F.struct(s["done"].alias("done"), F.array(x).alias("cur"), length.alias("n"))
        grown = F.struct(s["done"].alias("done"), F.concat(s["cur"], F.array(x)).alias("cur"), (s["n"] + length + extra).alias("n"))
        return F.when(full, sealed).when(restart & F.lit(at_end), fresh).otherwise(grown)

    finish = lambda s: F.when(F.size(s["cur"]) > 0, F.concat(s["done"], F.array(F.array_join(s["cur"], joiner)))).otherwise(s["done"])
    return F.aggregate(items, start, add, finish)


def snippet_chunks(definition: Column, examples: Column, limit: int = 800) -> Column:
    """A definition, by sentences if it is too long, then its examples, packed apart."""
    definition = F.coalesce(definition, F.lit(""))
    sentences = F.transform(_packed(F.split(definition, r"(?<=[.!?])\s+"), limit, " ", 1, True), lambda x: F.concat(F.lit("Definition: "), x))
    head = F.when(F.length(definition) <= limit, F.array(F.concat(F.lit("Definition: "), definition))).otherwise(sentences)
    listed = F.transform(F.coalesce(examples, _empty()), lambda x: F.concat(F.lit("- "), x))
    return F.concat(head, F.transform(_packed(listed, limit, "\n", 1, True), lambda x: F.concat(F.lit("Examples:\n"), x)))


def timeline_chunks(parts: Column, limit: int = 10_000) -> Column:
    """Pages packed in order, a blank line between two; a page over the limit stays whole."""
    return _packed(parts, limit, "\n\n", 2, False)


def manga_timeline(pages: DataFrame, by: list[str], file: str = "file", blocks: str = "blocks", limit: int = 10_000) -> DataFrame:
    """by, chunk_no, chunk: pages (blocks: array of struct lines array) in the order of their number, labelled and packed; blocks without words are left out, a page without any is its label."""
    said = F.filter(F.transform(F.col(blocks), lambda b: S.strip(F.array_join(b["lines"], " "))), lambda x: x != "")
    label = S.page_label(F.col("_n"), F.coalesce(said, F.array().cast(TEXTS)))
    p = pages.withColumn("_n", S.page_number(F.col(file))).withColumn("_page", label)
    grouped = p.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_n", F.col(file).alias("f"), "_page"))).alias("_pages"))
    return grouped.select(*by, F.posexplode(timeline_chunks(F.transform("_pages", lambda x: x["_page"]), limit)).alias("p", "chunk")).select(*by, (F.col("p") + 1).alias("chunk_no"), "chunk")


def front_matter(text: Column) -> tuple[Column, Column]:
    """(front matter with both fences, or empty; the body). An open fence that never closes makes all of it body."""
    lines = F.split(text, "\n")
    close = F.array_position(F.transform(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), S.strip), "---")
    has = (S.strip(F.get(lines, F.lit(0))) == "---") & (close > 0)
    head = F.array_join(F.slice(lines, F.lit(1), (close + 1).cast("int")), "\n")
    tail = F.array_join(F.slice(lines, (close + 2).cast("int"), F.greatest(F.size(lines) - 1 - close, F.lit(0)).cast("int")), "\n")
    return F.when(has, head).otherwise(""), F.when(has, tail).otherwise(text)


def markdown_sections(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """path, section_no, filename, content of every header's section; of equal names in a file the last counts.

    Text before the first header goes, as do sections whose name has no legal character.
    Front matter heads every section.
    """
    head, body = front_matter(F.col(content))
    # The head travels as line 0: a column beside the lines would be worked out anew for each.
    lines = files.select(F.col(path).alias("path"), F.posexplode(F.concat(F.array(head), F.split(body, "\n"))).alias("line_no", "line"))
    lines = lines.withColumn("is_header", (F.col("line_no") > 0) & F.col("line").rlike(r"^#+\s+\S*"))
    here = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("section_no", F.sum(F.col("is_header").cast("int")).over(here))
    lines = lines.withColumn("head", F.first("line").over(here)).filter("section_no > 0")
    s = lines.groupBy("path", "section_no").agg(
        F.max("head").alias("head"),
        F.max(F.when(F.col("is_header"), S.filename_deleted(F.regexp_extract("line", r"^#+\s+(.*)", 1)))).alias("title"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"),
    )
    s = s.filter("title <> ''")
    last = s.groupBy("path", "title").agg(F.max_by(F.struct("section_no", "head", "text"), "section_no").alias("s"))
    whole = F.when(F.col("s.head") == "", F.col("s.text")).otherwise(F.concat("s.head", F.lit("\n"), "s.text"))
    return last.select("path", F.col("s.section_no").alias("section_no"), F.concat("title", F.lit(".md")).alias("filename"), whole.alias("content"))


MARKER = r"<\|([^<>\n|]+(?:\|[^<>\n|]+)*)\|>"


def dialogue_blocks(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Records of coordinate-marked dialogue: composite_key, four ids, name, body, icon_index, keywords; the last block of a key in a file counts."""
    text = F.col(content)
    marks = F.regexp_extract_all(text, F.lit(MARKER), F.lit(1))
    parts = F.slice(F.split(text, MARKER, -1), F.lit(2), F.size(marks))
    b = files.select(F.col(path).alias("path"), F.posexplode(F.arrays_zip(marks.alias("mark"), parts.alias("part"))).alias("pos", "z")).select("path", "pos", "z.mark", "z.part")
    b = b.withColumn("lines", F.filter(F.transform(F.split("part", r"\r?\n"), S.strip), lambda x: x != "")).filter(F.size("lines") > 0)
    first = F.get("lines", F.lit(0))
    speaks = first.rlike(r"\\I\[\d+\]") | first.rlike("^[\"']") | first.rlike("[\"']$")
    b = b.withColumn("speaks", speaks)
    b = b.select(
        "path",
        "pos",
        "mark",
        F.when(F.col("speaks"), S.strip_quotes(M.without_icons(first))).otherwise("").alias("name"),
        F.when(F.col("speaks"), M.icon(first)).alias("icon_index"),
        F.array_join(F.when(F.col("speaks"), F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))).otherwise(F.col("lines")), "\n").alias("raw"),
    )
    ids = F.split("mark", r"\|")
    b = b.withColumn("keywords", M.keywords(F.col("raw"))).withColumn("body", M.without_colours(F.col("raw"))).filter("name <> '' or body <> ''")
    b = b.withColumn("composite_key", F.array_join(ids, "-"))
    for i, name in enumerate(("file_id", "map_id", "event_id", "line_id")):
        b = b.withColumn(name, F.coalesce(S.int_or_text(F.get(ids, F.lit(i))), F.lit("")))
    cols = ["file_id", "map_id", "event_id", "line_id", "name", "body", "icon_index", "keywords"]
    last = b.groupBy("path", "composite_key").agg(F.max_by(F.struct(*cols), "pos").alias("r"))
    return last.select("path", "composite_key", *[f"r.{c}" for c in cols])

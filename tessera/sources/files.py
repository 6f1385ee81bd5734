"""Files as DataFrames: tables, texts, pages, lorebooks, page scans."""

from __future__ import annotations

import sqlite3
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import strings as S

#: Cells that stand for nothing in a CSV file.
NOTHING = ("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "<NA>", "n/a", "#N/A")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, sanitize: bool = True) -> DataFrame:
    """CSV or Excel; headers become column names. Excel needs a reader that may not be installed and is read on the driver."""
    low = path.lower()
    if low.endswith(".csv"):
        reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        df = reader.schema(schema).option("enforceSchema", False).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    elif low.endswith((".xlsx", ".xls")):
        df = spark.createDataFrame(pd.read_excel(path))
    else:
        raise ValueError(f"unsupported file type: {path}")
    if sanitize:
        names = df.columns
        if low.endswith(".csv"):  # as written: the reader numbers repeats in its own way
            written = spark.read.option("multiLine", True).option("escape", '"').csv(path).first()
            names = [x or f"_c{i}" for i, x in enumerate(written)] if written is not None and len(written) == len(names) else names
        df = df.toDF(*S.unique_names(names))
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*NOTHING), F.col(f"`{c}`")) for c in text})


def read_sqlite(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One table of an SQLite file, through the driver: such files are read by one process."""
    with sqlite3.connect(path) as db:
        return spark.createDataFrame(pd.read_sql_query('SELECT * FROM "{}"'.format(table.replace('"', '""')), db))


def read_texts(spark: SparkSession, path: str, glob: str = "*", skip_dir: str = "debug") -> DataFrame:
    """path, content of whole files below a folder; files below a folder named skip_dir are left out."""
    df = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    df = df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    return df.filter(~F.array_contains(F.split("path", "/"), skip_dir)) if skip_dir else df


def read_targets(lines: DataFrame, value: str = "value") -> DataFrame:
    """name, url of target lists: `name | url` or `url`; blank and # lines are left out. What else the lines have comes first."""
    s = S.strip(F.col(value))
    more = [c for c in lines.columns if c != value]
    t = lines.select(*more, s.alias("line")).filter((F.col("line") != "") & ~F.col("line").startswith("#"))
    two = F.split("line", r"\|", 2)
    return t.select(*more, F.when(F.size(two) == 2, S.strip(two[0])).alias("name"), S.strip(F.element_at(two, -1)).alias("url"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """OCR pages: title_dir, file, blocks; a file that isn't such JSON is left out."""
    df = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").schema("blocks array<struct<lines:array<string>>>").json(path)
    p = F.col("_metadata.file_path")
    return df.filter(F.col("blocks").isNotNull()).select(F.regexp_extract(p, r"^(.*)/[^/]*$", 1).alias("title_dir"), F.regexp_extract(p, r"([^/]*)$", 1).alias("file"), "blocks")


def titled_pages(pages: DataFrame, path: str = "path") -> DataFrame:
    """pages with artist, title, part and file, from paths <artist>/<title>/_ocr/<file> and <artist>/<title>/_ocr/<part>/<file>.

    Where a title's _ocr folder has parts, files beside them aren't pages; deeper files never
    are. part is null for a title without. What has no such path is left out.
    """
    p = F.col(path)
    at = r"(?:^|/)([^/]+)/([^/]+)/_ocr/(?:([^/]+)/)?([^/]+)$"
    bit = lambda k: F.regexp_extract(p, at, k)
    rows = pages.filter(p.rlike(at)).withColumns({"artist": bit(1), "title": bit(2), "part": F.nullif(bit(3), F.lit("")), "file": bit(4), "_top": F.regexp_extract(p, r"^(.*/_ocr)/", 1)})
    parted = rows.filter("part is not null").select("_top").distinct().withColumn("_parted", F.lit(True))
    return rows.join(parted, "_top", "left").filter(F.col("part").isNotNull() | F.col("_parted").isNull()).drop("_top", "_parted")


def read_tropes(spark: SparkSession, path: str) -> DataFrame:
    schema = "Trope_Title string, Namespace string, Definition string, Examples array<string>, Scrape_Timestamp string, Source_URL string"
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.withColumns({"Namespace": F.coalesce("Namespace", F.lit("Main")), "Examples": F.coalesce("Examples", F.array().cast("array<string>")), "Source_URL": F.coalesce("Source_URL", F.lit(""))})


def pdf_text(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> DataFrame:
    """doc, text: page texts in order, a blank line between two; pages without text are left out."""
    p = pages.filter(~S.blank(F.col(text))).groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t")))).alias("ps"))
    return p.select(doc, F.array_join(F.transform("ps", lambda x: x["t"]), "\n\n").alias("text"))


def table_cells(rows: DataFrame, cells: str = "cells") -> DataFrame:
    """Extracted table rows: no null cells, no line breaks, no rows that are all blank."""
    clean = F.transform(cells, lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))
    return rows.withColumn(cells, clean).filter(F.exists(cells, lambda c: ~S.blank(c)))


class _Text(HTMLParser):
    """Text of a page but for its chrome; only the main part if the page has one."""

    SKIP = {"header", "footer", "nav", "aside", "script", "style"}
    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool]] = []
        self.all: list[str] = []
        self.main: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        names = (dict(attrs).get("class") or "").split()
        low = " ".join(names).lower()
        furniture = any(x in low for x in ("menu", "nav", "sidebar")) or any("footer" in n.replace("not-footer", "").replace("no-footer", "") for n in low.split())
        if tag not in self.VOID:
            self.stack.append((tag, tag in self.SKIP or furniture, "wsite-not-footer" in names))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data: str) -> None:
        if data.strip() and not any(skip for _, skip, _ in self.stack):
            self.all.append(data.strip())
            if any(main for *_, main in self.stack):
                self.main.append(data.strip())


def page_text(html: str | None, max_chars: int = 20_000) -> str:
    import unicodedata

    parser = _Text()
    parser.feed(html or "")
    parser.close()
    return unicodedata.normalize("NFKC", "\n\n".join(parser.main or parser.all))[:max_chars]


def parsed_text(html: Column) -> Column:
    """page_text() of each page, by a real parser."""

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(page_text)

    return F.pandas_udf(run, "string")(html)


def nfkc(text: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.str.normalize("NFKC")

    return F.pandas_udf(run, "string")(text)


def archived_pages(spark: SparkSession, vault: str) -> DataFrame:
    """snapshot, text of every <vault>/<snapshot>/singlefile.html."""
    df = spark.read.option("wholetext", True).text(f"{vault.rstrip('/')}/*/singlefile.html")
    return df.select(F.regexp_extract("_metadata.file_path", r"([^/]+)/singlefile\.html$", 1).alias("snapshot"), parsed_text(F.col("value")).alias("text"))


def hopper_counts(inputs: DataFrame, path: str | Column = "path") -> DataFrame:
    """kind, n: how many inputs wait for each ingestor."""
    kind = S.input_kind(F.col(path) if isinstance(path, str) else path)
    return inputs.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))

"""Files for people: notes, Markdown tables, CSV, JSON chunks."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tessera.functions import markup as M
from tessera.functions import strings as S
from tessera.sinks.shared import stored
from tessera.sinks.tables import TableStore


def inside(root: str, target: str) -> Path:
    """target below root, resolved; an error if it leads out."""
    top, full = Path(root).resolve(), (Path(root) / target).resolve()
    if not full.is_relative_to(top) or full == top:
        raise PermissionError(f"{target} is not inside {root}")
    return full


def write_whole(path: Path, text: str) -> None:
    """Through a temporary file beside it, so that a reader sees the old or the new text."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, suffix=".tmp")
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(name, path)


def write_notes(notes: DataFrame, vault: str) -> None:
    """<vault>/<system>/<subfolder>/<title>.md for every row; names are fixed, so a repeated task writes the same file. vault: a folder that all executors mount."""

    def run(rows: Iterator[Row]) -> None:
        for r in rows:
            write_whole(inside(vault, f"{r['system']}/{r['subfolder']}/{r['title']}.md"), r["markdown"])

    notes.select("system", "subfolder", "title", "markdown").foreachPartition(run)


# --- files as a relation ---------------------------------------------------------------------


def listing(folders: DataFrame, root: str) -> DataFrame:
    """path, size, modified (nanoseconds) of the files right in the given folders (column folder) below root; tasks list, one folder each at a time. root: a folder that all executors mount."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for folder in f["folder"]:
                at = Path(root) / folder
                if at.is_dir():
                    found = [(e.name, e.stat()) for e in os.scandir(at) if e.is_file() and not e.name.endswith(".tmp")]
                    yield pd.DataFrame({"path": [f"{folder}/{n}" if folder else n for n, _ in found], "size": [s.st_size for _, s in found], "modified": [s.st_mtime_ns for _, s in found]}).astype({"path": str, "size": "int64", "modified": "int64"})

    return folders.select("folder").distinct().mapInPandas(run, "path string, size long, modified long")


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def file_plan(wanted: DataFrame, ledger: DataFrame, found: DataFrame, prune: bool = True) -> DataFrame:
    """path, action: what makes the files found what they should be.

    wanted: path, sha256 of the new contents. ledger: path, sha256, size, modified of what the
    last run left. found: path, size, modified of what is there. A file is as the ledger says
    if size and time are. Actions: create (not there), replace (other content, or changed by
    somebody else), same, delete (only in the ledger and as it says), edited (not wanted any
    more, but changed by somebody else: left alone). Files that neither names are nobody's.
    Of paths wanted more than once the least digest is.
    """
    w = wanted.groupBy("path").agg(F.min("sha256").alias("want"))
    was = ledger.select("path", F.col("sha256").alias("had"), F.col("size").alias("_size"), F.col("modified").alias("_modified"))
    there = found.select("path", "size", "modified", F.lit(True).alias("there"))
    both = w.join(was, "path", "full").join(there, "path", "left")
    untouched = F.coalesce((F.col("size") == F.col("_size")) & (F.col("modified") == F.col("_modified")), F.lit(False))
    action = (
        F.when(F.col("want").isNotNull() & F.col("there").isNull(), "create")
        .when(F.col("want").isNotNull(), F.when(untouched & (F.col("want") == F.col("had")), "same").otherwise("replace"))
        .when(F.col("there").isNull(), "gone")
        .otherwise(F.when(untouched, "delete").otherwise("edited"))
    )
    keep = F.lit(True) if prune else F.col("want").isNotNull()
    return both.filter(keep).select("path", action.alias("action"), "want")


def sync_files(wanted: DataFrame, root: str, store: TableStore, name: str, prune: bool = True) -> dict[str, int]:
    """Make the files below root those of wanted (path, content), and tell how many were created, replaced, deleted, left.

    The table `name` of the store is the ledger; without prune only wanted files are looked at.
    Every action repeats harmlessly, and the ledger is written after the files, so a run that
    is lost is just done again. A second run writes nothing.
    """
    spark = wanted.sparkSession
    wanted = stored(wanted.select("path", "content", F.sha2(F.coalesce("content", F.lit("")), 256).alias("sha256")), "wanted-files")
    empty = spark.createDataFrame([], "path string, sha256 string, size long, modified long")
    ledger = store.read(name) if store.exists(name) else empty
    folders = wanted.select(folder_of(F.col("path")).alias("folder"))
    if prune:
        folders = folders.union(ledger.select(folder_of(F.col("path"))))
    plan = stored(file_plan(wanted, ledger, listing(folders.distinct(), root), prune), "file-plan")
    todo = plan.filter("action in ('create', 'replace')").join(wanted, (plan["path"] == wanted["path"]) & (plan["want"] == wanted["sha256"]))

    def put(rows: Iterator[Row]) -> None:
        for r in rows:
            write_whole(inside(root, r["path"]), r["content"] or "")

    def drop(rows: Iterator[Row]) -> None:
        for r in rows:
            inside(root, r["path"]).unlink(missing_ok=True)

    todo.select(wanted["path"], "content").foreachPartition(put)
    plan.filter("action = 'delete'").select("path").foreachPartition(drop)
    counts = {r["action"]: r["count"] for r in plan.groupBy("action").count().collect()}
    if set(counts) - {"same"}:
        now = listing(folders.distinct(), root)
        left = plan.filter("want is not null").select("path", F.col("want").alias("sha256")).join(now, "path")
        if prune:
            store.write(left, name, "replace") if store.exists(name) else store.write(left, name)
        else:
            store.write(left, name, key="path")
    return counts


def note_files(notes: DataFrame) -> DataFrame:
    """path, content of notes: <system>/<subfolder>/<title>.md."""
    return notes.select(F.concat(F.concat_ws("/", "system", "subfolder", "title"), F.lit(".md")).alias("path"), F.col("markdown").alias("content"))


def slice_files(sections: DataFrame) -> DataFrame:
    """path, content of sliced Markdown: <file without its ending>/<header>.md."""
    return sections.select(F.concat_ws("/", F.regexp_replace("path", r"\.[^./]*$", ""), "filename").alias("path"), "content")


def chunk_files(chunks: DataFrame, kind: str = "", source: str = "source", number: str = "chunk_no") -> DataFrame:
    """path, content of JSON chunks (system, source, number, json): <system>/<kind>_chunk_<source>_<number>.json, or <system>/chunk_<number>.json without kind and source; those that are not ok as ..._ERROR.txt with their error."""
    no = F.lpad(F.col(number).cast("string"), 3, "0")
    no = F.when(F.length(F.col(number).cast("string")) > 3, F.col(number).cast("string")).otherwise(no)
    stem = F.concat(F.lit(f"{kind}_chunk_"), S.filename_underscored(F.col(source)), F.lit("_"), no) if kind else F.concat(F.lit("chunk_"), no)
    good = F.concat_ws("/", "system", F.concat(stem, F.lit(".json")))
    bad = F.concat_ws("/", "system", F.concat(stem, F.lit("_ERROR.txt")))
    return chunks.select(F.when(F.col("ok"), good).otherwise(bad).alias("path"), F.when(F.col("ok"), F.col("json")).otherwise(F.concat(F.lit("ERROR: "), F.coalesce("error", F.lit("")), F.lit("\n\n"), F.coalesce("json", F.lit("")))).alias("content"))


def trope_files(chunks: DataFrame) -> DataFrame:
    """path, content of trope snippets: <title>_chunk_<number>.json, the stamp aside from what tells a new content, so that a later run rewrites nothing."""
    no = F.format_string("%03d", F.col("chunk_no").cast("int"))
    fields = F.struct("Trope_Title", "Namespace", "Clean_Content", "Source_URL")
    return chunks.select(F.concat(S.filename_underscored(F.col("Trope_Title")), F.lit("_chunk_"), no, F.lit(".json")).alias("path"), F.to_json(fields).alias("content"))


def lorebook_files(books: DataFrame) -> DataFrame:
    """path, content of whole lorebooks (system, lorebook): <system>_Master_Lorebook.json."""
    return books.select(F.concat(F.regexp_replace("system", " ", "_"), F.lit("_Master_Lorebook.json")).alias("path"), F.col("lorebook").alias("content"))


def markdown_rows(df: DataFrame, null_text: str = "None") -> DataFrame:
    """line_no, line: df as a padded Markdown table; rows in the order of all columns."""
    cells = df.select(*[M.cell(F.col(f"`{c}`"), null_text).alias(c) for c in df.columns])
    wide = cells.agg(*[F.greatest(F.coalesce(F.max(F.length(F.col(f"`{c}`"))), F.lit(0)), F.lit(max(3, len(c)))).alias(f"w{i}") for i, c in enumerate(df.columns)])
    pad = lambda x, i: F.concat(x, F.repeat(F.lit(" "), (F.col(f"w{i}") - F.length(x)).cast("int")))
    line = lambda parts: F.concat(F.lit("| "), F.concat_ws(" | ", *parts), F.lit(" |"))
    head = wide.select(F.lit(0).alias("k"), line([pad(F.lit(c), i) for i, c in enumerate(df.columns)]).alias("line"))
    rule = wide.select(F.lit(1).alias("k"), line([F.repeat(F.lit("-"), F.col(f"w{i}").cast("int")) for i in range(len(df.columns))]).alias("line"))
    body = cells.crossJoin(F.broadcast(wide)).select(F.lit(2).alias("k"), line([pad(F.col(f"`{c}`"), i) for i, c in enumerate(df.columns)]).alias("line"))  # wide: one row
    return head.unionByName(rule).unionByName(body)


def write_markdown(df: DataFrame, root: str, target: str, title: str, stamp: str, append: bool = False) -> bool:
    """A table export with front matter; false and no file if there is no row. The result is one file, so it is for results a person reads."""
    lines = [r["line"] for r in markdown_rows(df).orderBy("k", "line").collect()]
    if len(lines) <= 2:
        return False
    path = inside(root, target)
    table = "\n".join(lines)
    if append and path.exists():
        write_whole(path, path.read_text(encoding="utf-8") + f"\n\n## Additional Export ({stamp})\n\n{table}\n")
    else:
        write_whole(path, f"---\ntype: table-export\ntitle: {title}\ndate: {stamp}\n---\n\n# {title}\n\n{table}\n")
    return True


def write_scrubbed(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_chunks(chunks: DataFrame, path: str, errors: str) -> None:
    """Valid chunks as JSON by system, the others to a quarantine folder. chunks: system, ok and others."""
    chunks.filter("ok").drop("ok").write.mode("append").partitionBy("system").json(path)
    chunks.filter("not ok").drop("ok").write.mode("append").json(errors)

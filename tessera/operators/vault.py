"""A vault of linked notes, kept up to date: compile what is new, relink what new titles touch.

Next to the vault's files a table store keeps what the next run needs: `notes`, the compiled
texts without links, by path, with the digest of what they were compiled from; `terms`, the
titles that the links were made with; `postings`, in which notes which words follow which; and
`files`, the ledger of the files written. A run

1. compiles the entries whose note has another source than in `notes` or has no file,
2. compares the terms of all entries with `terms`, and through the postings finds the notes
   that hold the words of a term which is new, gone or leads elsewhere,
3. links these notes and the new ones, and no others, and writes the files that differ,
4. commits notes, postings and terms. A run that is lost before that is done again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import records as R
from tessera.functions import strings as S
from tessera.operators import inference as I
from tessera.operators import notes as N
from tessera.sinks import files as K
from tessera.sinks import tables as T
from tessera.sinks.shared import stored

PROMPT = "Compile this note. Keep its front matter."
#: Folders that postings are spread over by word.
SPREAD = 64


@dataclass
class Run:
    """What a run did: notes compiled and failed (path, error), notes linked again (path), and files by action."""

    compiled: DataFrame
    failed: DataFrame
    relinked: DataFrame
    files: dict[str, int]


def entries_of_files(files: DataFrame) -> DataFrame:
    """system, raw, ord of the entries of JSON files (system, path, raw), each read in the shape that its file's first entry decides; files that don't fit it give none."""
    shaped = R.entries_by_shape(files.withColumn("_at", F.struct("path", "system")), "_at").filter("ok")
    return shaped.select("path.system", F.col("entry").alias("raw"), F.struct("path.path", "place").alias("ord"))


def raw_notes(entries: DataFrame) -> DataFrame:
    """system, subfolder, title, markdown, path, sha256 of entries (system, raw, ord): of entries with one path the last by ord counts."""
    built = N.build_notes(entries, keep=("ord",))
    path = F.concat(F.concat_ws("/", "system", "subfolder", "title"), F.lit(".md"))
    built = built.withColumn("path", path).withColumn("sha256", S.content_hash(F.col("markdown")))
    last = built.groupBy("path").agg(F.max_by(F.struct("system", "subfolder", "title", "markdown", "sha256"), F.struct("ord", "sha256")).alias("n"))
    return last.select("path", "n.*")


def entry_terms(entries: DataFrame) -> DataFrame:
    """system, term, title: the title index of entries (system, raw, ord), under Speaker, name or title."""
    f = F.from_json("raw", "struct<Speaker:string,name:string,title:string>")
    named = F.coalesce(*[F.nullif(f[k], F.lit("")) for k in ("Speaker", "name", "title")])
    keys = F.coalesce(F.get_json_object("raw", "$.keys"), F.get_json_object("raw", "$.key"))
    listed = F.from_json(keys, "array<string>")
    keys = F.when(keys.startswith("["), listed).otherwise(F.split(F.coalesce(keys, F.lit("")), ","))
    e = entries.select("system", named.alias("name"), F.transform(F.coalesce(keys, F.array().cast("array<string>")), S.strip).alias("keys"), "ord").filter("name is not null")
    return N.title_index(e)


def _read(store: T.TableStore, name: str, schema: str) -> DataFrame:
    return store.read(name) if store.exists(name) else store.spark.createDataFrame([], schema)


NOTES = "path string, system string, title string, sha256 string, text string"
TERMS = "system string, term string, title string"


def _word_folder(word: str):
    return F.pmod(F.xxhash64(word), F.lit(SPREAD)).cast("int").alias("folder")


def _postings(store: T.TableStore) -> DataFrame:
    path = f"{store.root}/postings"
    schema = "system string, path string, sha256 string, word string, next string, folder int"
    return store.spark.read.schema(schema).parquet(path) if store.folder.exists("postings") else store.spark.createDataFrame([], schema)


def touched(store: T.TableStore, terms: DataFrame) -> DataFrame:
    """Paths of compiled notes that hold the words of a changed term. Only the postings' folders of these words are read."""
    changed = stored(N.changed_terms(_read(store, "terms", TERMS), terms, ("system",)), "changed-terms")
    first = F.coalesce(F.get(N.words_in(F.col("term")), F.lit(0)), F.lit(""))
    folders = [r[0] for r in changed.select(first.alias("word")).select(_word_folder("word")).distinct().collect()]  # at most SPREAD numbers
    postings = _postings(store).filter(F.col("folder").isin(folders)) if folders else _postings(store).limit(0)
    held = N.holding(postings.withColumn("at", F.struct("path", "sha256")), changed, ("system",), "at").select("at.*")
    return held.join(_read(store, "notes", NOTES).select("path", "sha256"), ["path", "sha256"], "left_semi").select("path").distinct()


def compile_vault(entries: DataFrame, store: T.TableStore, vault: str, provider: I.Provider, prompt: str = PROMPT, retry: I.Retry | None = None) -> Run:
    """Bring the vault up to date with all entries (system, raw, ord)."""
    spark = entries.sparkSession
    entries = stored(entries.select("system", "raw", "ord"), "vault-entries")
    raw = stored(raw_notes(entries), "raw-notes")
    known = _read(store, "notes", NOTES)
    found = K.listing(raw.select(K.folder_of(F.col("path")).alias("folder")), vault)
    todo = T.uncompiled(raw, known, found)
    made = I.generate(todo, provider, prompt, "markdown", retry or I.Retry(3, 2.0, 9.0))
    made = made.withColumn("text", S.from_front_matter(F.coalesce("answer", F.lit("")))).withColumn("check", N.checked(F.col("text")))
    made = stored(made.withColumn("ok", F.col("check.ok") & F.col("answer").isNotNull()).withColumn("error", F.coalesce("error", "check.message")), "made-notes")
    new = made.filter("ok").select("path", "system", "title", "sha256", "text")

    terms = stored(entry_terms(entries), "vault-terms")
    old = stored(touched(store, terms).join(new.select("path"), "path", "left_anti"), "touched-notes")
    relink = known.join(old, "path").select(*new.columns).unionByName(new)
    linked = N.autolink(relink, terms, "title", "text", ("system",))
    files = K.sync_files(linked.select("path", F.col("text").alias("content")), vault, store, "files", prune=False)

    if not new.isEmpty():
        store.write(new, "notes", key="path")
        words = N.postings_of(new, "text", ("system", "path", "sha256")).select("*", _word_folder("word"))
        words.repartition("folder").write.mode("append").partitionBy("folder").parquet(f"{store.root}/postings")
    if store.exists("terms"):
        store.write(terms, "terms", "replace")
    else:
        store.write(terms, "terms")
    return Run(new.select("path"), made.filter("not ok").select("path", "error"), old, files)

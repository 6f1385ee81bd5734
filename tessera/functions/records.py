"""Loosely typed JSON records of lorebooks and narratives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .strings import blank, strip

TEXTS = "array<string>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def string_or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def parse_keys(raw: Column) -> Column:
    """Trigger words from a JSON list, or from text parted by commas, else by semicolons, else as one; falsy gives none. raw: the JSON value as text, without quotes if it is a string."""
    listed = F.filter(F.transform(F.from_json(raw, TEXTS), strip), lambda x: ~blank(x))
    clean = lambda parts: F.filter(F.transform(parts, strip), lambda x: x != "")
    none = F.array().cast(TEXTS)
    text = F.when(F.contains(raw, F.lit(",")), clean(F.split(raw, ","))).when(F.contains(raw, F.lit(";")), clean(F.split(raw, ";"))).otherwise(F.array(strip(raw)))
    return F.when(blank(raw) | raw.isin("null", "[]", "false", "0"), none).when(strip(raw).startswith("["), F.coalesce(listed, none)).otherwise(text)


def entries_of(raw: Column) -> Column:
    """The entries of a lorebook as JSON texts, whatever its shape: a list, entries as list or object, digit keys, or an object of objects. Order stays."""
    listed = lambda x: F.from_json(x, TEXTS)
    values = lambda x: F.map_values(F.from_json(x, "map<string,string>"))
    looks = lambda v: v.startswith("{") & v.rlike(r'"(?:key|content|name)"\s*:')

    def keyed(whole: Column) -> Column:
        inner = strip(whole["entries"])
        digits = F.forall(F.map_keys(whole), lambda k: k.rlike("^[0-9]+$")) & (F.size(whole) > 0)
        other = F.when(digits, F.map_values(whole)).otherwise(F.filter(F.map_values(whole), looks))
        return let(inner, lambda i: F.when(i.startswith("{"), values(whole["entries"])).when(i.startswith("["), listed(whole["entries"])).otherwise(other))

    # Bound, so that a file is put together, stripped and parsed once, not for each use.
    found = let(strip(raw), lambda s: F.when(s.startswith("["), listed(s)).otherwise(let(F.from_json(s, "map<string,string>"), keyed)))
    return F.coalesce(found, F.array().cast(TEXTS))


def is_object(raw: Column) -> Column:
    return F.coalesce(strip(raw).startswith("{"), F.lit(False))


def lorebook_entry(raw: Column, number: Column) -> Column:
    """id, name, keys, content, insertion_order, priority of one entry; numbers that can't be read are 50."""
    f = F.from_json(raw, "map<string,string>")
    first = lambda *names: F.coalesce(*[string_or_null(f[n]) for n in names])
    whole = lambda name: F.coalesce(f[name].try_cast("int"), F.lit(50))
    keys = F.array_sort(F.array_distinct(F.concat(*[parse_keys(f[k]) for k in ("key", "keysecondary")])))
    return F.struct(
        number.cast("bigint").alias("id"),
        F.coalesce(first("name", "title"), F.concat(F.lit("Entry_"), number.cast("string"))).alias("name"),
        keys.alias("keys"),
        F.coalesce(first("content", "description"), F.lit("")).alias("content"),
        whole("insertion_order").alias("insertion_order"),
        whole("priority").alias("priority"),
    )


def ghost_rewrite(speaker: Column, dialogue: Column) -> tuple[Column, Column]:
    """A turn without words belongs to the surroundings."""
    empty = blank(dialogue)
    return F.when(empty, "System/Environment").otherwise(speaker), F.when(empty, "").otherwise(dialogue)


#: Required fields of the schemas and their JSON types.
SCHEMAS = {
    "narrative": {"Speaker": "STRING", "Dialogue": "STRING", "Scene Description": "STRING"},
    "lorebook": {"name": "STRING", "content": "STRING", "id": "BIGINT", "keys": "ARRAY<STRING>"},
    "trope": {"Trope_Title": "STRING", "Namespace": "STRING", "Definition": "STRING", "Examples": "ARRAY<STRING>"},
}


def valid(raw: Column, schema: str) -> Column:
    """True if every required field is there with its type; integers may be written as text, as whole decimals or as a truth value."""
    v = F.try_parse_json(raw)
    out = F.lit(True)
    for name, kind in SCHEMAS[schema].items():
        path = f"$['{name}']"
        got = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
        if kind == "BIGINT":
            text = F.try_variant_get(v, path, "string")
            good = got.rlike("^(?:BIGINT|INT|SMALLINT|TINYINT|BOOLEAN)$") | (got.rlike("^(?:STRING|DECIMAL|DOUBLE)") & text.rlike(r"^\s*[+-]?\d+(?:\.0*)?\s*$"))
        elif kind.startswith("ARRAY"):
            good = got.isin("ARRAY<STRING>", "ARRAY<VOID>")
        else:
            good = got == kind
        out = out & F.coalesce(good, F.lit(False))
    return out


def shape_of(first: Column) -> Column:
    """What a file's first entry says of all of its entries: lorebook, narrative or generic."""
    keys = F.coalesce(F.json_object_keys(F.when(is_object(first), first)), F.array().cast(TEXTS))
    has = lambda *names: F.arrays_overlap(keys, F.array(*map(F.lit, names)))
    return F.when(has("content", "keys", "name"), "lorebook").when(has("Dialogue", "Scene Description", "Speaker"), "narrative").otherwise("generic")


def entries_by_shape(files: DataFrame, path: str = "path", raw: str = "raw") -> DataFrame:
    """path, shape, ok, place (from 1), name, entry of every entry of files, in the shape that the file's first entry decides.

    Lorebook entries are brought to one form, those that are no objects left out with their
    places kept; narrative entries keep the three fields of their form. ok is false for all
    entries of a file of which one doesn't fit the shape: such a file isn't taken. A generic
    file's entries stay as they are, without a name. A file without entries gives no rows.
    """
    entries = F.col("_entries")
    f = files.withColumn("_entries", entries_of(F.col(raw))).withColumn("_shape", shape_of(F.get(entries, F.lit(0))))
    fits = F.when(F.col("_shape") == "narrative", F.forall(entries, lambda e: valid(e, "narrative"))).otherwise(F.lit(True))
    e = f.select(F.col(path).alias("path"), F.col("_shape").alias("shape"), fits.alias("ok"), F.posexplode("_entries").alias("_at", "entry")).withColumn("place", F.col("_at") + 1)
    e = e.filter((F.col("shape") != "lorebook") | is_object(F.col("entry")))
    book = lorebook_entry(F.col("entry"), F.col("place"))
    turn = F.from_json("entry", "struct<Speaker:string,Dialogue:string,`Scene Description`:string>")
    told = F.to_json(turn)
    name = F.when(F.col("shape") == "lorebook", book["name"]).when((F.col("shape") == "narrative") & F.col("ok"), turn["Speaker"])
    entry = F.when(F.col("shape") == "lorebook", F.to_json(book)).when((F.col("shape") == "narrative") & F.col("ok"), told).otherwise(F.col("entry"))
    return e.select("path", "shape", "ok", "place", name.alias("name"), entry.alias("entry"))

"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are values given to a name (`token = "..."`, `api_key: ...`), and unbroken
runs of 20 characters or more of keys and digests, known prefixes among them. The forest
looks at a candidate's length, changes between kinds of characters, coverage by a
dictionary, the path or source of the text, and the words before it. It is trained on a
fixed table of labelled findings made by rule from a seed. What it rates at THRESHOLD or
above is a secret; of overlapping candidates the first is rated.

A run is proposed whole, however long; a dot ends it and the next begins after it, so a
token of dotted parts gives one candidate for each part of 20 characters or more. Null
text counts as empty and a null path as no path; every row is rated by itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spans import SPAN, by_place, first_ones, listed, matches, small_table
from ._trees import Node, forest, forest_probability

THRESHOLD, AROUND = 0.6, 40
KINDS = ["assigned", "run"]
PATTERNS = {
    "assigned": r"""(?i)(?<![a-z0-9_])(?:[a-z0-9]{1,24}[_.-]){0,3}(?:token|secret|passw(?:or)?d|pwd|api_?key|access_?key|private_?key|auth|credential|key)s?["']?\x20{0,2}(?:=|:|:=|=>)\x20{0,2}["']?[^\s"'<>;,]{8,}""",
    "run": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}",
}
#: Fragments of common words; a value they cover well is prose or an identifier.
DICTIONARY = "the|and|ing|ion|ent|tion|for|ver|ter|ess|ate|con|com|pro|res|str|name|value|type|data|file|user|test|path|list|code|page|text|time|class|index|config|default|example|change|here|your|ung|der|ein|sch|lich|keit|heit|que|ment|eau|elle|oir|ción|ado|ado|los|est"
FEATURES = ["length", "changes", "hex", "digit_share", "upper_share", "lower_share", "covered", "distinct_share", "assigned", "says_secret", "says_digest", "says_sample", "prefix", "code_path", "test_path", "dashes", "vowel_share"]


def proposals(text: Column) -> Column:
    """Candidates by start. A cheap look comes first: most texts have neither a long run nor an assignment."""
    none = F.array().cast(SPAN)
    runs = F.when(text.rlike("[A-Za-z0-9_+/=-]{20}"), matches(text, PATTERNS["run"], "run", AROUND)).otherwise(none)
    names = F.when(text.rlike("[=:][=>]? {0,2}[\"']?[^\\s\"'<>;,]{8}"), matches(text, PATTERNS["assigned"], "assigned", AROUND)).otherwise(none)
    return by_place(F.concat(names, runs), KINDS)


def value_of(match: Column) -> Column:
    """The value of an assignment, or the run itself."""
    return F.regexp_replace(match, r"""^[^=:]*?(?:=|:|:=|=>)\x20{0,2}["']?(?=[^\s"'<>;,]{8})""", "")


def features(kind: Column, match: Column, before: Column, path: Column) -> dict[str, Column]:
    v = F.when(kind == "assigned", value_of(match)).otherwise(match)
    n = F.greatest(F.length(v), F.lit(1)).cast("double")
    real = lambda x: x.cast("double")
    count = lambda p: real(F.regexp_count(v, F.lit(p)))
    near = F.concat_ws(" ", before, F.when(kind == "assigned", match))
    return {
        "length": n,
        "changes": count("(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[a-z0-9]|(?<=[0-9])[A-Za-z]") / n,
        "hex": real(v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "digit_share": count("[0-9]") / n,
        "upper_share": count("[A-Z]") / n,
        "lower_share": count("[a-z]") / n,
        "covered": real(F.length(F.regexp_replace(F.lower(v), f"(?:{DICTIONARY})", ""))) / n,
        "distinct_share": real(F.size(F.array_distinct(F.split(v, "")))) / n,
        "assigned": real(kind == "assigned"),
        "says_secret": real(near.rlike(r"(?i)(?:token|secret|passw|pwd|api.?key|credential|private|bearer|auth)")),
        "says_digest": real(near.rlike(r"(?i)(?:commit|sha\d*|md5|digest|checksum|hash|uuid|guid|etag|revision|integrity)")),
        "says_sample": real(F.concat_ws(" ", near, v).rlike(r"(?i)(?:example|sample|dummy|placeholder|changeme|your|xxxx|test|none|null|\*\*\*\*)")),
        "prefix": real(v.rlike(r"^(?:AKIA|ASIA|gh[pousr]_|sk-|xox[baprs]-|eyJ|AIza|glpat-)")),
        "code_path": real(F.coalesce(path, F.lit("")).rlike(r"(?i)\.(?:py|js|ts|java|go|rb|env|ya?ml|json|toml|ini|cfg|sh)$")),
        "test_path": real(F.coalesce(path, F.lit("")).rlike(r"(?i)(?:test|spec|fixture|example|sample|doc)")),
        "dashes": count("[-_+/=]") / n,
        "vowel_share": count("(?i)[aeiou]") / n,
    }


def labelled_findings(n: int = 3000, seed: int = 20240301) -> list[dict]:
    """A table of candidates with their class, made by rule."""
    r = np.random.Generator(np.random.PCG64(seed))
    one = lambda *x: x[int(r.integers(len(x)))]
    some = lambda chars, k: "".join(chars[int(i)] for i in r.integers(0, len(chars), k))
    hexa, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pieces = DICTIONARY.split("|")
    word = lambda k: "".join(pieces[int(i)] for i in r.integers(0, len(pieces), k))
    rows = []
    for _ in range(n):
        good = bool(r.random() < 0.5)
        filler = " ".join(word(2) for _ in range(3)) + " "
        path = one("", "", "src7", "app/settings.py", "deploy/.env", "config.yml", "notes.md")
        if good:
            value = one(some(hexa, 40), some(hexa, 32), some(hexa, 40).upper(), some(alnum, int(r.integers(24, 64))), "AKIA" + some(alnum[:26] + "0123456789", 16), "ghp_" + some(alnum, 36), some(alnum + "+/", 40) + "=")
            if r.random() < 0.6:
                match, kind, before = f"{one('token', 'api_key', 'secret', 'db_password', 'access_key', 'TOKEN')}{one(' = ', '=', ': ')}{one('', chr(34))}{value}", "assigned", filler
            else:
                match, kind, before = value, "run", filler + one("token ", "secret ", "bearer ", "api key ", 'token = "', "password is ", "credential: ")
        else:
            value = one(word(9), word(8).upper(), some(hexa, 40), some(hexa, 8) + "-" + some(hexa, 4) + "-" + some(hexa, 4) + "-" + some(hexa, 12), "_".join(word(2) for _ in range(4)), "-" * 30, "=" * 40, "/".join(word(2) for _ in range(5)), some("0123456789", 24), "xxxxxxxxxxxxxxxxxxxxxxxx", "your_" + word(4) + "_here")
            digest = all(c in hexa + "-" for c in value) and value[:2] != "--"
            if digest or r.random() < 0.7:
                match, kind, before = value, "run", filler + (one("commit ", "sha1: ", "md5 ", "etag ", "revision ", "uuid ") if digest else one("", "see ", "in "))
            else:
                match, kind, before = f"{one('token', 'key', 'password', 'auth')}{one(' = ', ': ')}{one(word(4), 'your_' + word(3), 'example_' + word(3), 'changeme_' + word(2), word(5).lower())}", "assigned", filler
            path = one(path, path, "tests/fixtures.py", "docs/example.md")
        rows.append({"kind": kind, "text": match, "before": before[-AROUND:], "path": path, "good": int(good)})
    return rows


def train(spark: SparkSession) -> list[Node]:
    rows = small_table(spark, labelled_findings(), "kind:string,text:string,before:string,path:string,good:int")
    f = features(F.col("kind"), F.col("text"), F.col("before"), F.col("path"))
    table = rows.select("good", *[f[k].alias(k) for k in FEATURES]).collect()
    return forest({k: np.array([r[k] for r in table], float) for k in FEATURES}, np.array([r["good"] for r in table]))


def find(docs: DataFrame, text: str = "text", path: str | None = "source", into: str = "_secrets") -> DataFrame:
    """docs with a struct `into`: candidates (a count) and spans of secrets by start."""
    trees = train(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    where = F.col(path).cast("string") if path else F.lit("")
    out = docs.withColumn(into, proposals(whole))
    faced = F.transform(into, lambda x: F.struct(x.alias("x"), *[c.alias(k) for k, c in features(x["kind"], x["text"], x["before"], where).items()]))
    good = F.transform(F.filter(faced, lambda y: forest_probability(trees, {k: y[k] for k in FEATURES}) >= THRESHOLD), lambda y: y["x"])
    spans = F.when(F.size(into) > 0, first_ones(good)).otherwise(F.array().cast(SPAN))
    return out.withColumn(into, F.struct(F.size(into).cast("long").alias("candidates"), spans.alias("spans")))


def report(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """id, n_candidates, n_secrets, secrets (kind:start:end, comma-joined) of every row."""
    found = find(docs.select(F.col(id).alias(id), F.col(text).alias(text), F.col(path).alias(path)), text, path)
    return found.select(id, F.col("_secrets.candidates").alias("n_candidates"), F.size("_secrets.spans").cast("long").alias("n_secrets"), listed(F.col("_secrets.spans")).alias("secrets"))

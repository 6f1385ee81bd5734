"""Personal data: base patterns, and candidates that gradient-boosted trees select.

Base kinds are email, ip, card and phone by pattern, then by value (parts up to 255,
check sum, number of digits). Generators with high recall propose further spans, which
may overlap: numbers written as phone numbers or as ids, long numbers as accounts and
cards have them (their check sum is one feature among others), and addresses written out.
Trees rate each by its format and by the words around it. Base spans always stay; of the
others those are kept that overlap nothing kept before.

Trees are fitted to one table of labelled findings. Another, of other phrases, is for
odds and thresholds: on half of it the odds are calibrated, on the other half each kind
gets the lowest threshold that gives PRECISION. Both tables are made by rule from a seed
and of fixed size (see _findings). Patterns don't look back over characters twice, so long texts take linear time.
Null text counts as empty: no spans. Every row is rated by itself, so null ids and
repeated rows need no rule.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._findings import AROUND, CALIBRATE, FIT, labelled
from ._shared import fresh
from ._spans import SPAN, by_place, digits, fold, listed, luhn, matches, small_table, without_overlaps
from ._trees import Boosted, boost, threshold

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["written", "local", "number", "account"]
#: A start is the end of the match before, or a place not inside a run: elsewhere nothing new can match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "written": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\{at\}|\x20at\x20)\x20?[a-z0-9-]{1,64}+(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\x20dot\x20)\x20?[a-z0-9-]{2,64}+)++",
    "local": r"(?<![0-9+.-])(?:\([0-9]{2,5}\)|0[0-9]{1,4}|[0-9]{3})[\x20./-][0-9]{2,4}(?:[\x20.-][0-9]{2,5}){1,3}(?![0-9])",
    "number": r"(?<![0-9A-Za-z.-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{4}){3,7}|[A-Z]{1,2}[0-9]{6,9})(?![0-9A-Za-z-])",
    "account": r"(?<![0-9A-Za-z.+-])[0-9](?:[\x20-]?[0-9]){11,18}(?![0-9A-Za-z-])",
}
PRECISION, FIT_ROWS, CALIBRATE_ROWS = 0.97, 2400, 1600
FEATURES = ["length", "n_digits", "n_separators", "n_letters", "groups", "opens_round", "zero_first", "says_phone", "says_mail", "says_id", "says_other", "currency", "glued", "is_written", "is_local", "is_number", "is_account", "distinct_digits", "says_account", "domain", "check_sum", "fours", "date_like", "book_like", "card_start"]
_SAYS = {
    "says_phone": r"(?i)\b(?:phone|tel|call|mobile|cell|fax|whatsapp|telefon|anruf|numéro|teléfono|ring)\b",
    "says_mail": r"(?i)\b(?:mail|e-mail|email|contact|write|reach|adresse|correo|kontakt|send)\b",
    "says_id": r"(?i)\b(?:ssn|social|passport|iban|account|licen[cs]e|tax|identity|patient|konto|compte|cuenta|licence)\b",
    "says_account": r"(?i)\b(?:card|visa|mastercard|account|paid|charge|debit(?:ed)?|konto|karte|carte|compte|cuenta|tarjeta|iban)\b",
    "says_other": r"(?i)\b(?:order|invoice|version|isbn|page|part|model|serial|build|ticket|chapter|score|date|lot|item|ratio|article|section|tracking|timestamp|barcode|ean|sku|pedido|commande|facture|rechnung|seite)\b",
}


def base_spans(text: Column) -> Column:
    """Base spans, by start and kind. text: not null."""
    none = F.array().cast(SPAN)
    some = lambda guard, kind, good: F.when(guard, F.filter(matches(text, PATTERNS[kind], kind), lambda x: good(x["text"]))).otherwise(none)
    has_digit = text.rlike("[0-9]")
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2}|)"
    n = lambda x: F.length(digits(x))
    found = [
        some(F.contains(text, F.lit("@")), "email", lambda x: F.lit(True)),
        some(has_digit, "ip", lambda x: x.rlike(rf"^{part}(?:\.{part}){{3}}$")),
        some(has_digit, "card", lambda x: (n(x) >= 12) & (n(x) <= 19) & luhn(digits(x))),
        some(F.contains(text, F.lit("+")), "phone", lambda x: (n(x) >= 9) & (n(x) <= 15)),
    ]
    return by_place(F.concat(*found), BASE_KINDS)


def proposals(text: Column) -> Column:
    """Spans of all generators, with up to AROUND characters before and 8 after."""
    none = F.array().cast(SPAN)
    low_dot = text.rlike(r"(?i)[(\[{ ]dot[)\]} ]")
    has_digit = text.rlike("[0-9]")
    found = F.concat(
        F.when(low_dot, matches(text, PATTERNS["written"], "written", AROUND, 8)).otherwise(none),
        F.when(has_digit, matches(text, PATTERNS["local"], "local", AROUND, 8)).otherwise(none),
        F.when(has_digit, matches(text, PATTERNS["number"], "number", AROUND, 8)).otherwise(none),
        F.when(has_digit, matches(text, PATTERNS["account"], "account", AROUND, 8)).otherwise(none),
    )
    return by_place(found, ADDED_KINDS)


def features(kind: Column, match: Column, before: Column, after: Column) -> dict[str, Column]:
    """Of a candidate: its format, and what stands around it."""
    d = digits(match)
    real = lambda x: x.cast("double")
    out = {
        "length": real(F.length(match)),
        "n_digits": real(F.length(d)),
        "n_separators": real(F.length(F.regexp_replace(match, "[^ ().\\[\\]{}/-]", ""))),
        "n_letters": real(F.length(F.regexp_replace(match, "[^A-Za-z]", ""))),
        "groups": real(F.regexp_count(match, F.lit("[0-9]+"))),
        "opens_round": real(match.startswith("(")),
        "zero_first": real(match.startswith("0")),
        "currency": real(before.rlike(r"[$€£#§=xX*]\s*$") | after.rlike(r"^\s*(?:%|€|\$|kg|mm|cm|ms|GB|px)")),
        "glued": real(before.rlike(r"[A-Za-z0-9_]$") | after.rlike(r"^[A-Za-z0-9_]")),
        "distinct_digits": real(F.size(F.array_distinct(F.split(d, "")))),
        "domain": real(match.rlike(r"(?i)\b(?:com|org|net|edu|gov|info|io|eu|uk|de|fr|es|it|nl|at|ch)$")),
        "check_sum": real(F.when(kind == "account", luhn(d)).otherwise(False)),
        "fours": real(match.rlike(r"^(?:[0-9]{4}[ -]?){3}[0-9]{4}$")),
        "date_like": real(d.rlike("^(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])")),
        "book_like": real(d.rlike("^97[89][0-9]{10}$")),
        "card_start": real(d.rlike("^[3-6]")),
    }
    out |= {k: real(before.rlike(p)) for k, p in _SAYS.items()}
    return out | {f"is_{k}": real(kind == k) for k in ADDED_KINDS}


@dataclass(frozen=True)
class Model:
    trees: Boosted
    least: dict[str, float]


def rated_rows(spark: SparkSession, rows: list[dict]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Features and classes of a table of labelled rows, which is of fixed size."""
    f = features(F.col("kind"), F.col("text"), F.col("before"), F.col("after"))
    given = small_table(spark, rows, "kind:string,text:string,before:string,after:string,good:int")
    table = given.select("good", *[f[k].alias(k) for k in FEATURES]).collect()
    return {k: np.array([r[k] for r in table], float) for k in FEATURES}, np.array([r["good"] for r in table])


def train(spark: SparkSession) -> Model:
    """Trees from the fitting rows; from the two halves of the calibrating rows the odds and each kind's threshold."""
    x, y = rated_rows(spark, labelled(FIT, FIT_ROWS, 20240229))
    cx, cy = rated_rows(spark, labelled(CALIBRATE, CALIBRATE_ROWS, 20240307))
    half = np.arange(len(cy)) % 2 == 0
    model = boost(x, y, calibrate=({k: v[half] for k, v in cx.items()}, cy[half]))
    p = 1 / (1 + np.exp(-(model.a + model.b * model.odds(cx, len(cy)))))
    mine = lambda k: ~half & (cx[f"is_{k}"] == 1)
    return Model(model, {k: threshold(p[mine(k)], cy[mine(k)], PRECISION) for k in ADDED_KINDS})


def selected(found: Column, model: Model) -> Column:
    """Of proposed spans, those that the trees rate at their kind's threshold or above."""
    least = lambda x: F.coalesce(*[F.when(x["kind"] == k, F.lit(v)) for k, v in model.least.items()])
    # First what a candidate looks like, as one struct, then the trees over it.
    faced = F.transform(found, lambda x: F.struct(x.alias("x"), *[c.alias(k) for k, c in features(x["kind"], x["text"], x["before"], x["after"]).items()]))
    good = F.filter(faced, lambda y: model.trees.probability({k: y[k] for k in FEATURES}) >= least(y["x"]))
    return F.transform(good, lambda y: y["x"])


def find(docs: DataFrame, text: str = "text", into: str = "_private") -> DataFrame:
    """docs with a struct `into` of base and all spans, each by start."""
    model = train(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    base, extra = base_spans(whole), proposals(whole)
    out = docs.withColumn(into, F.struct(base.alias("base"), extra.alias("extra")))
    extra = F.when(F.size(f"{into}.extra") > 0, without_overlaps(selected(F.col(f"{into}.extra"), model), F.col(f"{into}.base"), ADDED_KINDS)).otherwise(F.array().cast(SPAN))
    out = out.withColumn(into, F.struct(f"{into}.base", extra.alias("added")))
    return out.withColumn(into, F.struct(f"{into}.base", by_place(F.concat(f"{into}.base", f"{into}.added"), BASE_KINDS + ADDED_KINDS).alias("spans")))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span replaced by [KIND]; of overlapping spans the first is replaced."""
    into = fresh(docs, "_private")
    found = find(docs, text, into)
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        inside = x["start"] < at
        kept = F.substring(whole, at + 1, x["start"] - at)
        return F.when(inside, at).otherwise(x["end"]), F.when(inside, none).otherwise(F.array(kept, F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))))

    rest = F.substring(whole, F.array_max(F.transform(f"{into}.spans", lambda x: x["end"])) + 1, F.length(whole))
    clean = F.concat(F.array_join(fold(F.col(f"{into}.spans"), F.lit(0), "array<string>", step), ""), rest)
    return found.withColumn(text, F.when(F.size(f"{into}.spans") > 0, clean).otherwise(F.col(text))).select(*docs.columns)


def report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans, n_added, n_spans of every row."""
    p = find(docs.select(F.col(id).alias(id), F.col(text).alias(text)), text)
    count = lambda k: F.size(F.filter("_private.base", lambda x: x["kind"] == k)).cast("long")
    added = (F.size("_private.spans") - F.size("_private.base")).cast("long")
    return p.select(id, *[count(k).alias(f"n_{k}") for k in BASE_KINDS], F.sha2(listed(F.col("_private.base")), 256).alias("base_sha256"), listed(F.col("_private.spans")).alias("spans"), added.alias("n_added"), F.size("_private.spans").cast("long").alias("n_spans"))

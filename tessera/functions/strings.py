"""String functions with the meaning they have in Python, as JVM expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ILLEGAL = r'[\\/*?:"<>|]'


def strip(c: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank(c: Column) -> Column:
    """True for null, empty or white space."""
    return strip(F.coalesce(c, F.lit(""))) == ""


def strip_quotes(c: Column) -> Column:
    """White space and quotes off both ends, in any mix."""
    return F.regexp_replace(c, "(?U)^[\\s\"']+|[\\s\"']+$", "")


def sanitize_name(name: str) -> str:
    """A table's column or own name: lower case, blanks, hyphens and slashes to underscores, dots away."""
    return name.strip().lower().translate(str.maketrans({" ": "_", "-": "_", "/": "_", ".": None}))


def sanitized(c: Column) -> Column:
    return F.replace(F.translate(F.lower(strip(c)), " -/", "___"), F.lit("."), F.lit(""))


def unique_names(names: list[str]) -> list[str]:
    """Sanitized names, a number behind repeats until no two are equal."""
    seen: set[str] = set()
    out = []
    for base in map(sanitize_name, names):
        name, n = base, 0
        while name in seen:
            n += 1
            name = f"{base}_{n}"
        seen.add(name)
        out.append(name)
    return out


def table_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def clean_header(name: str) -> str:
    """A header as a plain identifier."""
    joined = re.sub(r"[\s\-/.]+", "_", name.strip())
    return re.sub(r"_+", "_", re.sub(r"[^\w]", "", joined)).strip("_").lower()


def cleaned_header(c: Column) -> Column:
    joined = F.regexp_replace(strip(c), r"(?U)[\s\-/.]+", "_")
    plain = F.regexp_replace(F.regexp_replace(joined, r"(?U)[^\w]", ""), "_+", "_")
    return F.lower(F.regexp_replace(plain, "^_+|_+$", ""))


def filename_underscored(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r'[\\/*?:"<>| ]', "_"), "^_+|_+$", "")


def filename_dashed(c: Column) -> Column:
    """Illegal characters to dashes; nothing left gives "Unnamed"."""
    return F.coalesce(F.nullif(strip(F.regexp_replace(c, ILLEGAL, "-")), F.lit("")), F.lit("Unnamed"))


def filename_deleted(c: Column) -> Column:
    return strip(F.regexp_replace(c, ILLEGAL, ""))


def int_or_text(c: Column) -> Column:
    """Digits lose leading zeros; anything else stays, trimmed."""
    s = strip(c)
    return F.when(s.rlike("^[0-9]+$"), F.coalesce(F.nullif(F.regexp_replace(s, "^0+", ""), F.lit("")), F.lit("0"))).otherwise(s)


def json_part(c: Column) -> Column:
    """From the first bracket to the last of its kind; the trimmed text if there is none."""
    s = strip(c)
    found = F.regexp_extract(s, r"(?s)(\{.*\}|\[.*\])", 1)
    return F.when(found != "", found).otherwise(s)


def reasoning_cleaned(c: Column, drop_thoughts: bool = True) -> Column:
    """json_part() of a model's answer without its <think> spans."""
    return json_part(F.regexp_replace(c, r"(?s)<think>.*?</think>", "") if drop_thoughts else c)


def fences_stripped(c: Column) -> Column:
    s = strip(c)
    s = F.regexp_replace(s, r"^```json", "")
    s = F.regexp_replace(s, r"^```", "")
    return strip(F.regexp_replace(s, r"```$", ""))


def from_front_matter(c: Column) -> Column:
    """From the first --- on; all if there is none."""
    return F.when(F.contains(c, F.lit("---")), F.substr(c, F.instr(c, "---"))).otherwise(c)


def clean_wiki(c: Column) -> Column:
    """Tags, link brackets and URLs away, white space collapsed; null gives the empty text."""
    s = F.regexp_replace(c, r"<[^>]+>", "")
    s = F.regexp_replace(s, r"\[\[[^\]|]*\|([^\]]*)\]\]", "$1")
    s = F.regexp_replace(s, r"\[\[([^\]]*)\]\]", "$1")
    s = F.regexp_replace(s, r"https?://\S+", "")
    return F.coalesce(strip(F.regexp_replace(s, r"(?U)\s+", " ")), F.lit(""))


def fingerprint(title: Column, content: Column) -> Column:
    return F.concat(F.replace(F.lower(title), F.lit(" "), F.lit("_")), F.lit("_"), F.substring(F.md5(content), 1, 12))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def url_key(c: Column) -> Column:
    return F.md5(c)


def similarity(distance: Column) -> Column:
    return F.when(distance <= 1, 1 - distance).otherwise(F.lit(0.0))


def namespace(url: Column, known: list[str]) -> Column:
    """First path segment that is a known namespace, whatever its case; else Main."""
    lower = F.array(*[F.lit(k.lower()) for k in known])
    at = F.filter(F.transform(F.split(url, "/"), lambda s: F.array_position(lower, F.lower(s))), lambda i: i > 0)
    return F.when(F.size(at) > 0, F.element_at(F.array(*[F.lit(k) for k in known]), F.element_at(at, 1).cast("int"))).otherwise("Main")


def category_and_name(c: Column) -> tuple[Column, Column]:
    """What stands before the last slash, and after it."""
    return F.regexp_extract(c, r"(?s)^(.*)/([^/]*)$", 1), F.regexp_replace(c, r"(?s)^.*/", "")


def to_number(c: Column) -> Column:
    return c.try_cast("double")


def page_number(name: Column) -> Column:
    """First run of digits; 999999 if there is none."""
    return F.coalesce(F.regexp_extract(name, r"([0-9]+)", 1).try_cast("bigint"), F.lit(999999).cast("bigint"))


def page_label(number: Column, lines: Column) -> Column:
    head = F.concat(F.lit("--- Page "), number.cast("string"), F.lit(" ---"))
    return F.when(F.size(lines) > 0, F.concat(head, F.lit("\n"), F.array_join(lines, "\n"))).otherwise(head)


def numbered(lines: Column, context: Column | None = None) -> Column:
    """A prompt: lines numbered from 1, below an optional header."""
    body = F.array_join(F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    return body if context is None else F.when(blank(context), body).otherwise(F.concat(F.lit("Context: "), context, F.lit("\n"), body))


def lineage(title: Column, space: Column, segment: Column) -> Column:
    return F.concat(F.lit("[Trope: "), title, F.lit(" | Namespace: "), space, F.lit("] "), segment)


def system_name(first_dir: Column, file: Column, active: str) -> Column:
    """The first folder; else the active system for chunk files; else the file's own name without its usual parts."""
    own = file
    for part in ("main_", "_world_info", ".json"):
        own = F.replace(own, F.lit(part), F.lit(""))
    return F.when(~blank(first_dir), first_dir).when(F.contains(file, F.lit("chunk")), F.lit(active)).otherwise(F.replace(own, F.lit("_"), F.lit(" ")))


def input_kind(c: Column, is_ocr_dir: Column | None = None) -> Column:
    """Which ingestor an input goes to; the first rule that holds decides."""
    low = F.lower(c)
    out = F.when(low.rlike("^https?://"), "web").when(low.endswith(".pdf"), "pdf").when(low.rlike(r"\.(?:png|jpg|jpeg|webp|bmp)$"), "image")
    out = out.when(is_ocr_dir if is_ocr_dir is not None else F.contains(c, F.lit("_ocr")), "manga")
    return out.when(low.endswith(".json"), "json").otherwise("unrecognized")


#: Words in the message of an error that is worth another try.
RETRY_WORDS = ["rate limit", "throttled", "429", "503", "500", "timeout", "connection", "http"]

#: Phrases of a page that was served instead of its content.
BLOCKED_PHRASES = ["Enable JavaScript and cookies to continue", "429 Too Many Requests", "AuthenticationRequiredError", "bad network reputation"]


def retryable(message: Column) -> Column:
    return F.lower(message).rlike("|".join(re.escape(w) for w in RETRY_WORDS))


def blocked_page(text: Column) -> Column:
    """Pages that ask for scripts, patience or an account instead of showing content."""
    out = F.lit(False)
    for phrase in BLOCKED_PHRASES:
        out = out | F.contains(text, F.lit(phrase))
    return out


def stamp(at: Column, style: str = "iso") -> Column:
    """A time as text; the time is given, never taken."""
    return F.date_format(at, {"iso": "yyyy-MM-dd'T'HH:mm:ss", "file": "yyyy-MM-dd_HH-mm", "note": "yyyy-MM-dd HH:mm"}[style])

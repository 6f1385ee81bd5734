"""Calls to a language model as a step of a plan, and the pipelines around them."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol
from urllib.error import URLError

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import records as R
from tessera.functions import strings as S
from tessera.sinks.shared import stored

from . import segment as C


class Provider(Protocol):
    """Anything that answers; it is pickled to the tasks."""

    def generate(self, system: str, user: str, response_format: str | None = None) -> str: ...


@dataclass(frozen=True)
class RuleProvider:
    """Answers without a model, the same every time: the text back as one entry of a schema."""

    schema: str = "narrative"

    def generate(self, system: str, user: str, response_format: str | None = None) -> str:
        if self.schema == "narrative":
            entry: dict = {"Speaker": "Narrator", "Dialogue": user.strip(), "Scene Description": system.strip()}
        elif self.schema == "lorebook":
            words = user.split()
            entry = {"id": 1, "name": " ".join(words[:3]), "keys": words[:1], "content": user.strip(), "insertion_order": 50, "priority": 50}
        else:
            return user
        return json.dumps({"entries": [entry]})


@dataclass(frozen=True)
class Retry:
    """Tries, and seconds between two: random up to a bound that doubles; only for errors that `again` accepts."""

    tries: int = 5
    least: float = 2.0
    most: float = 30.0
    again: Callable[[Exception], bool] = lambda e: isinstance(e, (ConnectionError, TimeoutError, URLError)) or any(w in str(e).lower() for w in S.RETRY_WORDS)
    sleep: Callable[[float], None] = time.sleep

    def call(self, f: Callable[[], str]) -> str:
        for n in range(self.tries):
            try:
                return f()
            except Exception as e:
                if n + 1 == self.tries or not self.again(e):
                    raise
                self.sleep(random.uniform(self.least, min(self.most, self.least * 2**n)))
        raise AssertionError("no try")


def generate(df: DataFrame, provider: Provider, system: str, user: str, retry: Retry | None = None, delay: float = 0.0, into: str = "answer") -> DataFrame:
    """df with the provider's answer to each row, or the error beside a null answer. delay: seconds between two calls of one task."""
    schema = T.StructType([*df.schema.fields, T.StructField(into, T.StringType()), T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        policy = retry or Retry()
        for f in frames:
            answers, errors = [], []
            for text in f[user]:
                answer, error = _answer(policy, provider, system, text)
                answers.append(answer)
                errors.append(error)
                if delay:
                    time.sleep(delay)
            f[into], f["error"] = answers, errors
            yield f

    return df.mapInPandas(run, schema)


def paced(df: DataFrame, provider: Provider, system: str, user: str, delay: float, lanes: int, retry: Retry | None = None, into: str = "answer") -> DataFrame:
    """generate() at no more than one row each `delay` seconds in all, without a lock: rows are dealt to `lanes` tasks, the k-th of which waits k delays before its first row and lanes * delay from one row to the next. A row that is tried again counts as one."""
    dealt = df.repartition(lanes)
    schema = T.StructType([*df.schema.fields, T.StructField(into, T.StringType()), T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        policy, due = retry or Retry(), time.monotonic() + (TaskContext.get().partitionId() % lanes) * delay
        for f in frames:
            out = []
            for text in f[user]:
                time.sleep(max(0.0, due - time.monotonic()))
                due = time.monotonic() + lanes * delay
                out.append(_answer(policy, provider, system, text))
            f[into], f["error"] = [a for a, _ in out], [e for _, e in out]
            yield f

    return dealt.mapInPandas(run, schema)


def _answer(policy: Retry, provider: Provider, system: str, text: str) -> tuple[str | None, str | None]:
    try:
        return policy.call(lambda: provider.generate(system, text)), None
    except Exception as e:
        return None, str(e)


def in_rounds(df: DataFrame, call: Callable[[DataFrame], DataFrame], again: Callable[[Column], Column], tries: int = 4, wait: Callable[[int], float] = lambda n: min(30.0, 2.0**n), sleep: Callable[[float], None] = time.sleep, into: str = "answer") -> DataFrame:
    """df with the answers of `call`, its error and `attempts`: rows whose error `again` accepts are the input of the next round.

    A round is one pass over what is left, at most `tries` of them; no task sleeps, the driver
    waits wait(n) seconds after round n, so that a service gets its pause. Each round is a
    written table: a lost executor repeats a part of one round only. Rows that fail for good,
    or still after the last round, end with a null answer and their last error.
    call: adds `into` and error to its frame, and tries each row once.
    """
    left, done = stored(df, "round-0"), []
    for n in range(1, tries + 1):
        out = stored(call(left).withColumn("attempts", F.lit(n)), f"round-{n}")
        retry = F.lit(False) if n == tries else F.col(into).isNull() & F.coalesce(again(F.col("error")), F.lit(False))
        done.append(out.filter(~retry))
        left = out.filter(retry).select(*df.columns)
        if n == tries or left.isEmpty():
            break
        sleep(wait(n))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole


def fetched(targets: DataFrame, fetch: Callable[[str], str], url: str = "url", **rounds: Any) -> DataFrame:
    """targets with page, error and attempts: pages by `fetch`, which raises where there is none; what may be tried again is, in rounds. fetch is sent to the tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            pages, errors = [], []
            for u in f[url]:
                try:
                    pages.append(fetch(u))
                    errors.append(None)
                except Exception as e:
                    pages.append(None)
                    errors.append(str(e))
            f["page"], f["error"] = pages, errors
            yield f

    def call(df: DataFrame) -> DataFrame:
        return df.mapInPandas(run, T.StructType([*df.schema.fields, T.StructField("page", T.StringType()), T.StructField("error", T.StringType())]))

    return in_rounds(targets, call, S.retryable, into="page", **rounds)


def validated(df: DataFrame, schema: str, answer: str = "answer", thoughts: bool = True) -> DataFrame:
    """df with `json` (the answer's JSON part), its entries, and ok: all entries fit the schema."""
    part = S.reasoning_cleaned(F.col(answer)) if thoughts else S.strip(F.col(answer))
    d = df.withColumn("json", part).withColumn("entries", R.entries_of(F.col("json")))
    return d.withColumn("ok", F.coalesce(F.try_parse_json("json").isNotNull() & (F.size("entries") > 0) & F.forall("entries", lambda e: R.valid(e, schema)), F.lit(False)))


def harvest(sources: DataFrame, provider: Provider, prompt: str, schema: str, text: str = "text", limit: int = 8000, overlap: int = 1, clean: bool = True) -> DataFrame:
    """Whole texts to chunks to answers to validated entries; bad answers stay, with ok false, for the quarantine."""
    chunks = sources.select(*[c for c in sources.columns if c != text], F.posexplode(C.paragraph_chunks(F.col(text), limit, overlap, whole=True)).alias("chunk_no", "chunk")).withColumn("chunk_no", F.col("chunk_no") + 1)
    return validated(generate(chunks, provider, prompt, "chunk"), schema, thoughts=clean)


def narrative_entries(answers: DataFrame) -> DataFrame:
    """One row for each entry of good answers, turns without words given to the surroundings."""
    keep = [c for c in answers.columns if c not in ("answer", "error", "json", "entries", "ok", "chunk")]
    e = answers.filter("ok").select(*keep, F.posexplode("entries").alias("entry_no", "entry"))
    f = F.from_json("entry", "struct<Speaker:string,Dialogue:string,`Scene Description`:string>")
    speaker, dialogue = R.ghost_rewrite(f["Speaker"], f["Dialogue"])
    return e.select(*keep, "entry_no", speaker.alias("Speaker"), dialogue.alias("Dialogue"), f["Scene Description"].alias("Scene Description"))


def vision(segments: DataFrame, provider: Provider, prompt: str, context: Column | None = None) -> DataFrame:
    """Grouped segments of images to narrative entries: one prompt for each image."""
    g = segments.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("segment_no", "text"))).alias("s"))
    g = g.select("image_id", S.numbered(F.transform("s", lambda x: x["text"]), context).alias("chunk"))
    return narrative_entries(validated(generate(g, provider, prompt, "chunk"), "narrative"))


def scripts(pages: DataFrame, provider: Provider, prompt: str, limit: int = 10_000) -> DataFrame:
    """path, content, ok: one JSON file of entries for each title, or part of one, of OCR pages (artist, title, part, file, blocks): <artist>/manga_chunk_<title>[_<part>].json.

    All of a title's answers must be good: otherwise ok is false and content null, and no
    file should be written. Parts of one title have files of their own.
    """
    by = ["artist", "title", "part"]
    answers = validated(generate(C.manga_timeline(pages, by, limit=limit), provider, prompt, "chunk"), "narrative")
    turns = narrative_entries(answers).withColumn("_e", F.struct("chunk_no", "entry_no", F.to_json(F.struct("Speaker", "Dialogue", "Scene Description")).alias("j")))
    said = turns.groupBy(*by).agg(F.array_sort(F.collect_list("_e")).alias("_es"))
    whole = answers.groupBy(*by).agg(F.bool_and("ok").alias("ok"))
    same = F.lit(True)
    w, t = whole.alias("w"), said.alias("t")
    for c in by:
        same = same & F.col(f"w.{c}").eqNullSafe(F.col(f"t.{c}"))
    both = w.join(t, same, "left").select("w.*", "_es")
    name = F.concat_ws("_", F.lit("manga_chunk"), "title", "part")
    content = F.concat(F.lit('{"entries":['), F.array_join(F.transform(F.coalesce("_es", F.array().cast("array<struct<chunk_no:int,entry_no:int,j:string>>")), lambda e: e["j"]), ","), F.lit("]}"))
    return both.select(F.concat("artist", F.lit("/"), name, F.lit(".json")).alias("path"), F.when(F.col("ok"), content).alias("content"), "ok")


def compile_markdown(files: DataFrame, found: DataFrame, provider: Provider, prompt: str, retry: Retry | None = None) -> DataFrame:
    """path, content, error of raw notes (path, content) whose output isn't found (path) yet: answers from their front matter on, under the same path. A failure has null content and its error."""
    todo = files.join(found.select("path").distinct(), "path", "left_anti")
    made = generate(todo, provider, prompt, "content", retry or Retry(3, 2.0, 9.0))
    return made.select("path", S.from_front_matter(F.col("answer")).alias("content"), "error")


def manga(pages: DataFrame, provider: Provider, prompt: str, by: list[str], limit: int = 10_000) -> DataFrame:
    return narrative_entries(validated(generate(C.manga_timeline(pages, by, limit=limit), provider, prompt, "chunk"), "narrative"))


def trope_chunks(tropes: DataFrame, stamp: Column, limit: int = 800, provider: Provider | None = None) -> DataFrame:
    """Definitions and examples to snippets with their lineage; a trope without title or definition has none. Without a provider definitions are cleaned by rule; examples stay as they are."""
    t = tropes.filter((F.coalesce("Trope_Title", F.lit("")) != "") & (F.coalesce("Definition", F.lit("")) != ""))
    if provider is None:
        t = t.withColumn("Definition", S.clean_wiki(F.col("Definition")))
    else:
        t = generate(t, provider, "Clean this definition.", "Definition").withColumn("Definition", F.coalesce(S.fences_stripped(F.col("answer")), S.clean_wiki(F.col("Definition"))))
    t = t.withColumn("Examples", F.coalesce("Examples", F.array().cast("array<string>")))
    c = t.select("Trope_Title", "Namespace", "Source_URL", F.posexplode(C.snippet_chunks(F.col("Definition"), F.col("Examples"), limit)).alias("p", "segment"))
    return c.select("Trope_Title", "Namespace", (F.col("p") + 1).alias("chunk_no"), S.lineage(F.col("Trope_Title"), F.col("Namespace"), F.col("segment")).alias("Clean_Content"), "Source_URL", stamp.alias("Generation_Timestamp"))


def audit(results: DataFrame, status: str = "status") -> DataFrame:
    """status, n: how a run went."""
    return results.groupBy(status).agg(F.count(F.lit(1)).alias("n"))

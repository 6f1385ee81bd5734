import datetime
import json
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import inference as I
from tessera.operators import joins as J
from tessera.operators import layout as L
from tessera.operators import notes as N
from tessera.operators import profile as P
from tessera.operators import vault as V2
from tessera.operators import vectors as V
from tessera.plans.workbench import SqlWorkbench
from tessera.sinks import files as K
from tessera.sinks import tables as T
from tessera.sources import files as X
from tessera.streaming import hopper as H


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


def test_table_store(spark, tmp_path):
    s = T.TableStore(spark, str(tmp_path))
    one = spark.createDataFrame([(1, "one"), (2, "two")], "id int, val string")
    assert s.write(one, "My-T") == "create" and s.tables() == ["my_t"]
    with pytest.raises(T.TableExists):
        s.write(one, "My-T")
    with pytest.raises(KeyError, match="not found"):
        s.write(one, "t2", key="nope")
    new = spark.createDataFrame([(1, "ONE"), (3, "x"), (3, "three")], "id int, val string").coalesce(1)
    before = s.snapshot("My-T")
    assert s.write(new, "My-T", key="ID") == "upsert"
    assert rows(s.read("My-T"), "id") == [(1, "ONE"), (2, "two"), (3, "three")]
    s.restore("My-T", before)
    assert rows(s.read("My-T"), "id") == [(1, "one"), (2, "two")]
    assert s.write(one.select("id"), "My-T", "append") == "append" and s.read("My-T").count() == 4
    with pytest.raises(ValueError):
        s.write(one.withColumn("z", F.lit(1)), "My-T", "append")
    assert s.write(one.limit(1), "My-T", "replace") == "replace" and s.read("My-T").count() == 1


def test_merge_rewrites_only_the_buckets_of_the_batch(spark, tmp_path):
    s = T.TableStore(spark, str(tmp_path), buckets=8)
    old = [(i, f"v{i}", float(i)) for i in range(200)] + [(None, "none", 0.0)]
    s.write(spark.createDataFrame(old, "id long, val string, x double"), "t", key="id")
    before = dict(s.version("t").parts)
    batch = spark.createDataFrame([(5, "a", 1), (5, "b", 3), (5, "c", 2), (1000, "new", 1), (None, "p", 1), (None, "q", 1)], "id int, val string, seq int")
    assert s.write(batch, "t", key="id", order=["seq"]) == "upsert"
    after = dict(s.version("t").parts)
    touched = {r.b for r in batch.select(T.bucket_of(F.col("id"), 8).alias("b")).collect()}
    assert 0 < len(touched) < 8 and {b for b in after if after[b] != before.get(b)} == touched
    # What the batch lacks stays where the key was known; null keys meet nothing.
    want = [(i, "b" if i == 5 else v, x) for i, v, x in old] + [(1000, "new", None), (None, "p", None), (None, "q", None)]
    assert sorted(map(tuple, s.read("t").collect()), key=repr) == sorted(want, key=repr)
    s.resize("t", 3)
    assert {b for b, _ in s.version("t").parts} <= {0, 1, 2} and sorted(map(tuple, s.read("t").collect()), key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="would repeat"):
        s.write(spark.createDataFrame([(5, "z")], "id long, val string"), "t", "append")
    assert s.write(spark.createDataFrame([], batch.schema), "t", key="id", order=["seq"]) == "upsert" and s.read("t").count() == len(want)


def test_keys_for_tables_without_and_order_of_writers(spark, tmp_path):
    s = T.TableStore(spark, str(tmp_path), buckets=4)
    plain = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    s.write(plain, "t")
    s.write(plain.limit(1), "t", "append")
    with pytest.raises(ValueError, match="can't be its key"):
        s.write(plain, "t", key="id")
    s.write(plain, "t", "replace")
    assert s.write(spark.createDataFrame([(2, "B")], "id int, v string"), "t", key="id") == "upsert"
    assert rows(s.read("t"), "id") == [(1, "a"), (2, "B")]
    assert s.write(spark.createDataFrame([(2,), (7,)], "id int"), "t", key="id") == "upsert"  # a key alone changes nothing known
    assert rows(s.read("t"), "id") == [(1, "a"), (2, "B"), (7, None)]

    class Second(T.TableStore):
        """Another writer commits in the middle of the first's merge."""

        def _commit(self, name, v):
            if not getattr(self, "met", False):
                self.met = True
                T.TableStore(spark, str(tmp_path), buckets=4).write(spark.createDataFrame([(8, "other")], "id int, v string"), name, key="id")
            super()._commit(name, v)

    assert Second(spark, str(tmp_path), buckets=4).write(spark.createDataFrame([(9, "mine")], "id int, v string"), "t", key="id") == "upsert"
    assert rows(s.read("t"), "id")[-2:] == [(8, "other"), (9, "mine")]


def test_vacuum_honours_pins(spark, tmp_path):
    s = T.TableStore(spark, str(tmp_path), buckets=2)
    for k in range(5):
        s.write(spark.createDataFrame([(0, k)], "id int, v int"), "t", key="id")
        if k == 1:
            s.snapshot("t", "Good one")
    os.makedirs(tmp_path / "t/data/unfinished")
    s.vacuum("t", keep=1)
    assert s.versions("t") == [2, 5] and (tmp_path / "t/data/unfinished").exists()
    assert s.read("t", "Good one").first().v == 1
    s.restore("t", "Good one")
    assert s.read("t").first().v == 1 and s.versions("t") == [2, 5, 6]
    s.unpin("t", "Good one")
    s.vacuum("t", keep=1, grace=-1)
    assert s.versions("t") == [6] and s.read("t").first().v == 1 and len(os.listdir(tmp_path / "t/data")) == 1


def test_csv_profile_scrub(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Game Name,MIX-%,MIX-%,Empty\n"a, b",1,x,\n"c\nd",NA,y,\n,,,\n')
    df = X.read_table(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["game_name", "mix_%", "mix_%_1", "empty"]
    out = P.scrub(df)
    assert out.columns == ["game_name", "mix", "mix_1"] and out.count() == 2
    assert {r.column_name: r.null_count for r in P.null_profile(df).collect()}["empty"] == 3
    assert P.null_profile(df.limit(0)).first().null_pct == 0.0
    g = spark.createDataFrame([("a", "1"), ("a", "x"), ("b", None), (None, "9")], "k string, v string")
    assert rows(P.group_sum(g, "k", "v"), "k") == [("a", 1.0), ("b", 0.0)]
    with pytest.raises(ValueError):
        X.read_table(spark, "a.txt")


def test_sources(spark, tmp_path):
    t = spark.createDataFrame([("# no",), (" ",), ("n | u|v",), (" http://x ",)], "value string")
    assert rows(X.read_targets(t), "url") == [(None, "http://x"), ("n", "u|v")]
    html = "<html><nav>no</nav><div class='wsite-not-footer'><p>Test &amp; Block</p><script>x</script></div><div class='footer'>f</div>out</html>"
    assert X.page_text(html) == "Test & Block"
    assert X.page_text("<p>ﬁ</p><div class='side-menu'>m</div>") == "fi" and X.page_text(None) == ""
    os.makedirs(tmp_path / "7")
    (tmp_path / "7" / "singlefile.html").write_text(html)
    assert rows(X.archived_pages(spark, str(tmp_path)), "snapshot") == [("7", "Test & Block")]
    p = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a"), ("d", 3, " ")], "doc string, page int, text string")
    assert rows(X.pdf_text(p), "doc") == [("d", "a\n\nb")]
    c = spark.createDataFrame([(["a\nb", None],), ([None, " "],)], "cells array<string>")
    assert [r.cells for r in X.table_cells(c).collect()] == [["a b", ""]]


def test_files(spark, tmp_path):
    n = spark.createDataFrame([("S", "f", "t", "x")], "system string, subfolder string, title string, markdown string")
    K.write_notes(n, str(tmp_path))
    assert (tmp_path / "S/f/t.md").read_text() == "x"
    with pytest.raises(PermissionError):
        K.inside(str(tmp_path / "a"), "../ab/c")
    df = spark.createDataFrame([(1, "x\ny"), (22, None)], "id int, name string")
    assert K.write_markdown(df, str(tmp_path), "o/t.md", "T", "2024-01-01") and not K.write_markdown(df.limit(0), str(tmp_path), "n.md", "T", "d")
    text = (tmp_path / "o/t.md").read_text()
    assert "| id  | name |" in text and "| 1   | x y  |" in text and "| 22  | None |" in text
    K.write_markdown(df, str(tmp_path), "o/t.md", "T", "2024-01-02", append=True)
    assert "## Additional Export (2024-01-02)" in (tmp_path / "o/t.md").read_text()


def test_notes(spark):
    title, folder, text = N.note_of({"name": "A/B", "keys": "k1, é", "content": "c [Type: core-rule] d [Cost: 3]"}, "Sys")
    assert (title, folder) == ("A-B", "Core-Rule") and 'aliases: ["k1", "\\u00e9"]' in text and "cost: 3" in text and text.endswith("# A/B\n\nc  d\n")
    assert N.note_of({"Speaker": "", "Dialogue": "hi"}, "S")[0] == "System-Environment"
    notes = ["---\nk: the boys'\n---", '---\nk: 5"\n---', "---\nk: 'x\"\n---", "---\na: 1\n---\nx", "x", "---\na: 1", "---\nabc\n---", "---\n: v\n---", "---\nk: [a]\n---", '---\nk: "x\n---', '---\n# c\nk: ["x"]\n---', "", None]
    want = [True, True, False, True, False, False, False, False, False, False, True, False, False]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(notes)], "i int, t string")
    got = df.select("i", N.well_formed(F.col("t")).alias("a"), N.checked(F.col("t")).alias("b")).orderBy("i").collect()
    assert [bool(r.a) for r in got] == want and [r.b.ok for r in got] == want
    titles = {"fire": "Fire", "fire storm": "Fire Storm", "ab": "Ab"}
    link = lambda t, own="": N.link_text(t, N.terms_by_first(titles), own)
    assert link("a `b\nfire\n` fire, bonfire fires [x] [fire](u\nfire) ``` fire") == "a `b\nfire\n` [[Fire]], bonfire fires [x] [fire](u\nfire) ``` [[Fire]]"
    assert link("---\nfire\n---\nfire storm, FIRE `fire` [[fire]] [fire](x) ab") == "---\nfire\n---\n[[Fire Storm]], [[Fire]] `fire` [[fire]] [fire](x) ab"
    assert link("Fire storm", "fire storm") == "Fire storm"
    idx = spark.createDataFrame([("fire", "Fire"), ("the sun", "Sol")], "term string, title string")
    n = spark.createDataFrame([("x", "Fire and the Sun"), ("y", "none")], "title string, markdown string")
    assert rows(N.autolink(n, idx), "title") == [("x", "[[Fire]] and [[Sol|the Sun]]"), ("y", "none")]


def test_autolink_by_keys_equals_all_terms(spark, monkeypatch):
    """Terms without words, of one word and of many with the same first one; null texts and titles; systems apart."""
    terms = {"fire": "Fire", "fire storm": "Fire Storm", "the sun": "Sol", "the moon": "Luna", "the sun-dial": "Dial", "???": "What", "élan vital": "É", "ab": "Ab", "x_1": "Under", "#tag": "Tag", "the": "Article"}
    texts = ["Fire and the Sun. THE MOON; the  moon", "the sun-dial a???b fire storm", "Élan vital x_1 #tag a#tag the", None, "", "ab the\nsun", "`fire` [[the sun]] [x](fire) the sun"]
    index = spark.createDataFrame([("s", k, v) for k, v in terms.items()] + [("r", "fire", "Other")], "system string, term string, title string")
    n = [("s", f"T{i}", x) for i, x in enumerate(texts)] + [("s", "Fire", "fire the fire"), ("s", None, "fire"), ("r", "T0", "Fire, the sun"), (None, "T", "fire"), ("s", "T0", "fire again")]
    df = spark.createDataFrame(n, "system string, title string, markdown string")
    want = sorted(((s, t, None if x is None else N.link_text(x, N.terms_by_first({"fire": "Other"} if s == "r" else terms if s else {}), t or "")) for s, t, x in n), key=repr)
    for few in (64, 1, 0):
        monkeypatch.setattr(N, "FEW_TERMS", few)
        assert sorted(map(tuple, N.autolink(df, index, within=("system",)).collect()), key=repr) == want
    assert N.autolink(df.limit(0), index, within=("system",)).count() == 0


def test_lorebook(spark):
    f = spark.createDataFrame([("S", "b", '[{"name":"3"}]'), ("S", "a", '{"entries":{"x":{"name":"1","key":["k"]},"y":5,"z":{"name":"2"}}}')], "system string, path string, raw string")
    u = N.lorebook_union(f)
    assert [(r.uid, json.loads(r.entry)["name"]) for r in u.orderBy("uid").collect()] == [(1, "1"), (2, "2"), (3, "3")]
    book = json.loads(N.lorebook_v3(u).first().lorebook)
    first = {"id": 1, "uid": 1, "name": "1", "key": ["k"], "keys": ["k"], "constant": False, "selective": False, "order": 100, "position": 1, "disable": False}
    assert book["name"] == "S Core Rules" and book["scan_depth"] == 50 and book["recursive_scanning"] is True and book["entries"]["1"] == first
    odd = spark.createDataFrame([("S", "a", '[{"uid":9,"or\\"der é":{"a":[1.50,null,"x\\ny"]},"order":"7","keys":null,"key":["k"]}]')], "system string, path string, raw string")
    got = json.loads(N.lorebook_entries(N.lorebook_union(odd)).first().entry)
    assert got == {"id": 1, "uid": 1, 'or"der é': {"a": [1.5, None, "x\ny"]}, "order": "7", "keys": None, "key": ["k"], "constant": False, "selective": False, "position": 1, "disable": False}


def test_layout(spark):
    b = [("i", k, float(x), float(y), t, 0.9) for k, (x, y, t) in enumerate([(300, 100, "world"), (200, 100, "Hello"), (205, 115, "again"), (600, 600, "Other"), (5, 5, "12")])] + [("i", 9, 210.0, 100.0, "unsure", 0.2)]
    df = spark.createDataFrame(b, "image_id string, box_id int, x double, y double, text string, conf double")
    p = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    df = L.boxes(df.withColumn("quad", F.array(p(0, 0), p(80, 0), p(80, 10), p(0, 10)))).withColumns({"width": F.lit(1000.0), "height": F.lit(1000.0)})
    assert [(r.segment_no, r.text) for r in L.group_boxes(df).orderBy("segment_no").collect()] == [(1, "Hello world again"), (2, "Other")]
    assert L.group_boxes(df, right_to_left=True).orderBy("segment_no").first().text == "world Hello again"


def test_vectors(spark):
    e = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "id int, embedding array<float>")
    assert [r.id for r in V.nearest(e, [0.1, 0.0], 9).collect()] == [1, 2, 3]
    q = e.filter("id = 1").withColumnRenamed("id", "query_id")
    assert [(r.id, r["rank"]) for r in V.nearest_to_each(e, q, 2).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    t = spark.createDataFrame([("A b", "x"), ("A b", "x"), ("A b", "y"), ("", "z")], "title string, content string")
    v = V.vault_rows(t)
    assert v.count() == 2 and V.insert_absent(v.limit(1), v).count() == 1
    assert abs(sum(x * x for x in e.select(V.hashed_embedding(F.lit("a b a"))).first()[0]) - 1) < 1e-6


def test_inference(spark):
    d = spark.createDataFrame([(1, "one\n\ntwo"), (2, "")], "id int, text string")
    a = I.harvest(d, I.RuleProvider(), "p", "narrative", limit=4)
    assert I.narrative_entries(a).count() == 2

    class Bad:
        def generate(self, system, user, response_format=None):
            raise ValueError("no")

    b = I.validated(I.generate(d, Bad(), "p", "text", I.Retry(2, again=lambda e: True, sleep=lambda s: None)), "narrative")
    assert [(r.ok, r.error) for r in b.collect()] == [(False, "no")] * 2
    t = spark.createDataFrame([("T", "Main", "<b>def</b>", ["[[e]]"], "u")], "Trope_Title string, Namespace string, Definition string, Examples array<string>, Source_URL string")
    assert [r.Clean_Content for r in I.trope_chunks(t, F.lit("now")).orderBy("chunk_no").collect()] == ["[Trope: T | Namespace: Main] Definition: def", "[Trope: T | Namespace: Main] Examples:\n- [[e]]"]


def entry(name, content, keys=()):
    return json.dumps({"name": name, "keys": list(keys), "content": content})


def test_vault_links_new_titles_only_where_they_are(spark, tmp_path):
    """First run, nothing new, ten new titles, a lost file, a bad answer: files against linking everything at once."""
    store, vault = T.TableStore(spark, str(tmp_path / "store"), buckets=4), tmp_path / "vault"
    said = tmp_path / "said"
    said.mkdir()

    class Echo:
        def generate(self, system, user, response_format=None):
            with open(said / f"{os.getpid()}", "a") as f:
                f.write(user.split("# ")[1].split("\n")[0] + "\n")
            if "# Bad" in user:
                raise ValueError("no")
            return "Sure!\n" + user

    def compile_all(entries):
        for f in said.iterdir():
            f.unlink()
        df = spark.createDataFrame([("Sys", raw, i) for i, raw in enumerate(entries)], "system string, raw string, ord int")
        run = V2.compile_vault(df, store, str(vault), Echo(), retry=I.Retry(1))
        calls = sorted(x for f in said.iterdir() for x in f.read_text().splitlines())
        titles = {}
        for raw in entries:
            e = json.loads(raw)
            titles |= {k.lower(): e["name"] for k in [e["name"], *e["keys"]]}
        want = {}
        for raw in entries:
            e = json.loads(raw)
            if e["name"] != "Bad":
                want[f"Sys/General_Rules/{e['name']}.md"] = N.link_text(N.note_of(e, "Sys")[2], N.terms_by_first(titles), e["name"])
        assert {str(f.relative_to(vault)): f.read_text() for f in vault.rglob("*.md")} == want
        return run, calls

    old = [entry(f"Note {i}", f"about item {i}, Note {i + 1} and star {i}", [f"alias{i}"]) for i in range(30)] + [entry("Bad", "never")]
    run, calls = compile_all(old)
    assert len(calls) == 31 and run.files == {"create": 30} and [tuple(r) for r in run.failed.collect()] == [("Sys/General_Rules/Bad.md", "no")]
    run, calls = compile_all(old)
    assert calls == ["Bad"] and run.relinked.count() == 0 and run.files == {}
    more = old + [entry(f"Star {i}", "shines on alias3") for i in range(10)]
    run, calls = compile_all(more)
    assert len(calls) == 11 and sorted(r.path for r in run.relinked.collect()) == sorted(f"Sys/General_Rules/Note {i}.md" for i in range(10))
    assert run.files == {"create": 10, "replace": 10}
    (vault / "Sys/General_Rules/Note 7.md").unlink()
    run, calls = compile_all(more)
    assert calls == ["Bad", "Note 7"] and run.files == {"create": 1}
    changed = [entry("Note 0", "now of star 5", ["alias3"]), *more[1:3], entry("Note 3", "plain"), *more[4:]]
    run, calls = compile_all(changed)
    assert calls == ["Bad", "Note 0", "Note 3"] and run.relinked.count() == 10  # the stars hold alias3, which leads elsewhere


def test_files_are_reconciled(spark, tmp_path):
    store, root = T.TableStore(spark, str(tmp_path / "store")), tmp_path / "out"
    tropes = lambda definition: spark.createDataFrame([("A b", "Main", definition, ["e"], "u"), ("C", "Main", "d", [], "u")], "Trope_Title string, Namespace string, Definition string, Examples array<string>, Source_URL string")
    sync = lambda definition, stamp: K.sync_files(K.trope_files(I.trope_chunks(tropes(definition), F.lit(stamp))), str(root), store, "tropes")
    long = " ".join(f"Sentence {i} is here." for i in range(80))
    assert sync(long, "t1") == {"create": 5}
    files = sorted(f.name for f in root.iterdir())
    assert files == ["A_b_chunk_001.json", "A_b_chunk_002.json", "A_b_chunk_003.json", "A_b_chunk_004.json", "C_chunk_001.json"]
    (root / "mine.txt").write_text("not the sink's")
    version = store.snapshot("tropes")
    assert sync(long, "t2") == {"same": 5} and store.snapshot("tropes") == version  # a second run writes nothing
    (root / "A_b_chunk_004.json").write_text("edited")
    # A shorter definition: higher chunks go, but for the one that somebody edited.
    assert sync("short", "t3") == {"replace": 2, "delete": 1, "edited": 1, "same": 1}
    assert sorted(f.name for f in root.iterdir()) == ["A_b_chunk_001.json", "A_b_chunk_002.json", "A_b_chunk_004.json", "C_chunk_001.json", "mine.txt"]
    (root / "C_chunk_001.json").unlink()
    assert sync("short", "t4") == {"create": 1, "same": 2}
    assert json.loads((root / "C_chunk_001.json").read_text())["Clean_Content"] == "[Trope: C | Namespace: Main] Definition: d"


def test_names_of_files(spark):
    c = spark.createDataFrame([("S", "a/b c", 7, True, "{}", None), ("S", "x", 1234, False, "raw", "bad")], "system string, source string, chunk_no int, ok boolean, json string, error string")
    assert rows(K.chunk_files(c, "web"), "path") == [("S/web_chunk_a_b_c_007.json", "{}"), ("S/web_chunk_x_1234_ERROR.txt", "ERROR: bad\n\nraw")]
    assert [r[0] for r in rows(K.chunk_files(c), "path")] == ["S/chunk_007.json", "S/chunk_1234_ERROR.txt"]
    s = spark.createDataFrame([("d/rules.md", "Poison.md", "# Poison")], "path string, filename string, content string")
    assert rows(K.slice_files(s), "path") == [("d/rules/Poison.md", "# Poison")]
    b = spark.createDataFrame([("My Sys", "{}")], "system string, lorebook string")
    assert rows(K.lorebook_files(b), "path") == [("My_Sys_Master_Lorebook.json", "{}")]
    n = spark.createDataFrame([("S", "f", "t", "x")], "system string, subfolder string, title string, markdown string")
    assert rows(K.note_files(n), "path") == [("S/f/t.md", "x")]


def test_rounds_of_calls(spark, tmp_path):
    """Counts of attempts and dead letters for a provider and a page fetcher; no task waits."""
    seen, waits = str(tmp_path), []

    def count(name):
        with open(f"{seen}/{name}", "a") as f:
            f.write("x")
        return os.path.getsize(f"{seen}/{name}")

    def fetch(url):
        n = count(url)
        if url == "gone" or (url == "slow" and n < 3) or url == "never":
            raise OSError({"gone": "404 not found", "slow": "503 busy", "never": "Connection reset"}[url])
        return f"page {url}"

    targets = spark.createDataFrame([("a",), ("slow",), ("gone",), ("never",)], "url string").repartition(3)
    got = I.fetched(targets, fetch, tries=4, wait=lambda n: 2.0**n, sleep=waits.append)
    assert sorted(map(tuple, got.select("url", "page", "error", "attempts").collect())) == [("a", "page a", None, 1), ("gone", None, "404 not found", 1), ("never", None, "Connection reset", 4), ("slow", "page slow", None, 3)]
    assert waits == [2.0, 4.0, 8.0] and {u: os.path.getsize(f"{seen}/{u}") for u in ("a", "slow", "gone", "never")} == {"a": 1, "slow": 3, "gone": 1, "never": 4}

    class Moody:
        def generate(self, system, user, response_format=None):
            if count(user) < int(user[1]):
                raise TimeoutError("timeout")
            return user.upper()

    d = spark.createDataFrame([("p1",), ("p2",), ("p9",)], "t string")
    got = I.in_rounds(d, lambda x: I.generate(x, Moody(), "", "t", I.Retry(1)), I.S.retryable, tries=3, sleep=waits.append)
    assert sorted(map(tuple, got.select("t", "answer", "error", "attempts").collect())) == [("p1", "P1", None, 1), ("p2", "P2", None, 2), ("p9", None, "timeout", 3)]
    assert I.in_rounds(d.limit(0), lambda x: I.generate(x, Moody(), "", "t"), I.S.retryable).count() == 0


def test_rate_of_all_tasks_together(spark, tmp_path):
    class Clock:
        def generate(self, system, user, response_format=None):
            import time

            (tmp_path / user).write_text(str(time.time()))
            return user

    d = spark.range(24).select(F.col("id").cast("string").alias("t"))
    assert I.paced(d, Clock(), "", "t", 0.1, 4).filter("answer = t").count() == 24
    at = sorted(float((tmp_path / str(i)).read_text()) for i in range(24))
    for window in (0.5, 1.0):
        assert max(sum(a <= x < a + window for x in at) for a in at) <= window / 0.1 + 4  # tasks don't begin at one moment


def test_entries_take_the_shape_of_the_first(spark):
    files = [("a", '[{"name":"N","keys":"k"},5,{"Speaker":"S"}]'), ("b", '[{"Dialogue":"d","Speaker":"S","Scene Description":"x","more":1}]'), ("c", '[{"Speaker":"S"},{"name":"n"}]'), ("d", "[5,{\"name\":\"n\"}]"), ("e", "[]"), ("f", None), ("g", "{bad")]
    df = spark.createDataFrame([("Sys", p, r) for p, r in files], "system string, path string, raw string")
    got = {(r.path, r.place): (r.shape, r.ok, r["name"]) for r in N.R.entries_by_shape(df).collect()}
    assert got == {("a", 1): ("lorebook", True, "N"), ("a", 3): ("lorebook", True, "Entry_3"), ("b", 1): ("narrative", True, "S"), ("c", 1): ("narrative", False, None), ("c", 2): ("narrative", False, None), ("d", 1): ("generic", True, None), ("d", 2): ("generic", True, None)}
    e = V2.entries_of_files(df).orderBy("ord").collect()
    assert [(r.system, r.ord.path, r.ord.place) for r in e] == [("Sys", "a", 1), ("Sys", "a", 3), ("Sys", "b", 1), ("Sys", "d", 1), ("Sys", "d", 2)]
    assert json.loads(e[2].raw) == {"Speaker": "S", "Dialogue": "d", "Scene Description": "x"}


def test_sketches_of_parts_are_those_of_the_whole(spark):
    from tessera.operators import sketches as Z

    whole = spark.range(20_000).selectExpr("id % 3 AS g", "CASE WHEN id % 10 > 0 THEN (id * 7919) % 10007 END AS x", "concat('s', id % 500) AS s")
    parts = [Z.sketched(whole.filter(f"x % 4 = {k}" if k < 4 else "x is null"), ["g"]) for k in range(5)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    got = {(r.g, r.column_name): r for r in Z.profile(Z.merged(both, ["g"])).collect()}
    for g in range(3):
        known = sorted(r.x for r in whole.filter(f"g = {g} and x is not null").collect())
        r, n = got[g, "x"], whole.filter(f"g = {g}").count()
        assert (r["rows"], r.nulls, r.low, r.high) == (n, n - len(known), known[0], known[-1]) and abs(r["mean"] - sum(known) / len(known)) < 1e-6
        for q, v in ((0.25, r.q25), (0.5, r.q50), (0.75, r.q75)):
            assert abs(sum(x <= v for x in known) / len(known) - q) <= Z.RANK_ERROR
        assert abs(r.n_unique - len(set(known))) <= 5 * Z.DISTINCT_ERROR * len(set(known)) and abs(got[g, "s"].n_unique - 500) <= 17 and got[g, "s"].q50 is None
    assert Z.sketched(whole.limit(0)).count() == 0


def test_raw_notes_and_titles_with_parts(spark):
    files = spark.createDataFrame([("a/x.md", "raw"), ("a/y.md", "raw two"), ("z.md", "bad")], "path string, content string")

    class Maker:
        def generate(self, system, user, response_format=None):
            if user == "bad":
                raise ValueError("no")
            return f"Here: ---\nk: v\n---\n{user}"

    found = spark.createDataFrame([("a/y.md",)], "path string")
    assert rows(I.compile_markdown(files, found, Maker(), "p", I.Retry(1)), "path") == [("a/x.md", "---\nk: v\n---\nraw", None), ("z.md", None, "no")]
    paths = ["i/A/T/_ocr/p_1.json", "i/A/U/_ocr/p_1.json", "i/A/U/_ocr/v2/p_2.json", "i/A/U/_ocr/v2/deep/p_3.json", "i/A/U/p_4.json", "A/V/_ocr/x/9.json"]
    got = X.titled_pages(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert sorted(map(tuple, got.select("artist", "title", "part", "file").collect()), key=repr) == [("A", "T", None, "p_1.json"), ("A", "U", "v2", "p_2.json"), ("A", "V", "x", "9.json")]
    blocks = lambda *x: [(list(lines),) for lines in x]
    pages = [("A", "T", None, "p_10.json", blocks([" b "])), ("A", "T", None, "p_2.json", blocks(["a", "c"], [" "], [])), ("A", "T", None, "p_3.json", None), ("A", "U", "v", "p_1.json", blocks(["no"]))]
    df = spark.createDataFrame(pages, "artist string, title string, part string, file string, blocks array<struct<lines:array<string>>>")

    class Strict(I.RuleProvider):
        def generate(self, system, user, response_format=None):
            return "nothing" if "no" in user else super().generate(system, user, response_format)

    got = {r.path: (r.ok, r.content) for r in I.scripts(df, Strict(), "s").collect()}
    assert got["A/manga_chunk_U_v.json"] == (False, None)
    assert json.loads(got["A/manga_chunk_T.json"][1]) == {"entries": [{"Speaker": "Narrator", "Dialogue": "--- Page 2 ---\na c\n\n--- Page 3 ---\n\n--- Page 10 ---\nb", "Scene Description": "s"}]}


def test_joins(spark):
    l = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9)], "id int, k string, at int")
    r = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y")], "k string, at int, v string")
    assert rows(J.asof_join(l, r, ["k"], "at", ["v"]), "id") == [(1, "a", 5, "y"), (2, "a", 1, None), (3, "b", 9, None)]
    assert J.range_join(l, r.select("k", F.col("at").alias("y")), "at", "y", 1.0, [("id", "y")]).count() == 1


def test_workbench(spark):
    w = SqlWorkbench(spark)
    w.register("odd_name", spark.range(3).toDF("x"))
    assert w.table("odd_name").count() == 3 and w.from_sqlite("SELECT ifnull(x, 0) AS x FROM odd_name WHERE 'A' LIKE 'a'").count() == 3
    with pytest.raises(PermissionError):
        w.query("DROP TABLE odd_name")


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    store = T.TableStore(spark, str(tmp_path / "w"))
    for name in ("a", "b"):
        (src / f"{name}.txt").write_text(name)
        H.sweep(H.hopper(spark, str(src)), H.upsert_into(store, "files", "path"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.content for r in store.read("files").collect()) == ["a", "b"]
    ev = str(tmp_path / "ev")
    at = datetime.datetime(2024, 1, 1)
    e = spark.createDataFrame([(i, at + datetime.timedelta(minutes=7 * i), i % 3, "e", 1.0) for i in range(30)], "event_id long, ts timestamp, user_id long, event_type string, value double")
    e.write.parquet(ev)
    stream = spark.readStream.schema(e.schema).parquet(ev)
    for name, f in (("tumbling", H.tumbling), ("sliding", H.sliding), ("sessions", H.sessions), ("running", H.running_totals)):
        mode = "update" if name == "running" else "complete"
        q = f(stream).writeStream.format("memory").queryName(f"s_{name}").outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
        got = sorted(map(tuple, spark.table(f"s_{name}").collect()))
        if name != "running":
            assert got == sorted(map(tuple, f(e).collect()))
        else:
            assert got == [(k, 10, 10.0) for k in range(3)]


def test_lorebook_union_spreads_entries_of_one_file(spark):
    raw = json.dumps([{"name": f"n{i}"} if i % 3 else "no object" for i in range(300)])
    files = spark.createDataFrame([("s", "b", raw), ("s", None, '[{"name":"first"}]'), ("t", "b", '{"0":{"name":"x"}}')], "system string, path string, raw string")
    u = N.lorebook_union(files)
    got = {(r.system, r.uid): json.loads(r.entry)["name"] for r in u.collect()}
    assert got == {("s", 1): "first", ("t", 1): "x"} | {("s", k + 2): f"n{i}" for k, i in enumerate(i for i in range(300) if i % 3)}
    assert u.select(F.spark_partition_id()).distinct().count() > 1


def visits_by_rule(rows, width):
    out = []
    for known, user, first, last, n, total in sorted(rows):
        if out and out[-1][:2] == [known, user] and first < out[-1][3] + width:
            out[-1] = [known, user, out[-1][2], max(last, out[-1][3]), out[-1][4] + n, out[-1][5] + total]
        else:
            out.append([known, user, first, last, n, total])
    return out


def test_merged_visits():
    r = random.Random(7)
    for n in (0, 1, 300):
        rows = [(r.random() < 0.9, r.choice([0, 3, (1 << 62) + 1, (1 << 62) + 2]), at := r.randrange(5000), at + r.choice([0, 0, 40]), r.randint(1, 3), float(r.randint(0, 9))) for _ in range(n)]
        frame = pd.DataFrame({c: np.array([x[i] for x in rows], k) for i, (c, k) in enumerate(zip(("known", "user", "first", "last", "n", "total"), ("bool", "int64", "int64", "int64", "int64", "float64")))})
        assert H.merged_visits(frame, 10).values.tolist() == pd.DataFrame(visits_by_rule(rows, 10), columns=frame.columns).values.tolist()
        assert H.merged_visits(frame, 10)["user"].tolist() == [x[1] for x in visits_by_rule(rows, 10)]


def test_visits_of_many_users_in_few_calls(spark, tmp_path, monkeypatch):
    """State is held by groups of users, not by user; users with the same group, and events of nobody, keep apart."""
    monkeypatch.setattr(H, "USER_GROUPS", 3)
    monkeypatch.setattr(H, "GATHERED", 5)
    begin, minute = datetime.datetime(2024, 1, 1), datetime.timedelta(minutes=1)
    r = random.Random(11)
    events = [(r.choice([None, *range(40)]), begin + r.randrange(600) * minute, float(r.randint(0, 9))) for _ in range(500)]
    schema, src = "user_id long, ts timestamp, value double", str(tmp_path / "in")
    days = datetime.timedelta(days=2)
    for part in ([e for e in events if e[1] < begin + 300 * minute], [e for e in events if e[1] >= begin + 300 * minute], [(-1, begin + days, 0.0)]):
        spark.createDataFrame(part, schema).coalesce(2).write.mode("append").parquet(src)
        run = H.visits(spark.readStream.schema(schema).parquet(src)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
        run.awaitTermination()
        assert run.recentProgress[-1].stateOperators[0].numRowsTotal <= 3
    us = lambda t: int((t - begin) / datetime.timedelta(microseconds=1))
    want = [[u if k else None, begin + datetime.timedelta(microseconds=a), begin + datetime.timedelta(microseconds=b), n, v] for k, u, a, b, n, v in visits_by_rule([(e[0] is not None, e[0] or 0, us(e[1]), us(e[1]), 1, e[2]) for e in events], us(begin + 30 * minute))]
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(map(str, map(list, got))) == sorted(map(str, want))

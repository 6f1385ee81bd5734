"""Main text, filter audit and manifest against plain versions of themselves, with nulls, empty, long, tied and repeated rows, and clashing names."""

import hashlib
import itertools
import re
import zlib

import pytest

from tessera.llm import filter_audit, main_text, merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, g string, part string, h string, idx long, kids string"
LOREM = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore."


def docs_of(spark, rows):
    """rows: (doc_id, text, lang, source, n_chars); the last columns clash with names that operators use."""
    return spark.createDataFrame([(*r, 5, "g", "p", "h", 3, "k") for r in rows], DOCS).repartition(3, "doc_id")


# --- main text -------------------------------------------------------------------------------

PAGES = {
    "template": (
        f'<!DOCTYPE html><html><head><title>No</title><style>p{{a:b}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">a</a></li></ul></nav><!-- no --><div class="ad">Buy now, today.</div>'
        f"<article><h1>Head &amp; all</h1><p><b>{LOREM}<br><p>Of.</p><p>a&#32;b\n\t c&eacute;</p></article><footer>&copy; x</footer>",
        f"Head & all {LOREM} Of. a b cé",
    ),
    "wrapper named after its sidebar": (f'<div class="page with-sidebar"><header><h1>Site</h1></header><div id=c><h2>T</h2><p>{LOREM}</p><ul><li>one<li>two</ul></div><div class=sidebar><p>{LOREM}</p></div></div>', f"T {LOREM} one two"),
    "comments by name": (f"<main><article><p>{LOREM}<p>Two<table><tr><td>a<td>b<tr><td>c</table></article><section class=user-comments><article class=comment><p>{LOREM * 5}</article></section></main>", f"{LOREM} Two a b c"),
    "comments by heading": (f"<div><div><p>{LOREM}</p><p>{LOREM}</p></div><div><h3>12 Comments</h3><p>{LOREM}</p></div></div>", f"{LOREM} {LOREM}"),
    "no names at all": (f"<table><tr><td><div><a href=1>Home</a> <a href=2>News</a></div></td><td><p>{LOREM}</p><p>{LOREM} Read <a href=3>this</a>.</p></td></tr></table><div>Copyright 2024 Someone, all rights.</div>", f"{LOREM} {LOREM} Read this."),
    "bare divs, notice, form": (f"<body><div class='cookie-notice'>We use cookies.</div><div class=post><h1>T</h1><div>{LOREM}</div><div>{LOREM}</div><blockquote>Tiny.</blockquote></div><form><p>Subscribe {LOREM}</p></form>", f"T {LOREM} {LOREM} Tiny."),
    "text alone": ("  a &lt; b\n c ", "a < b c"),
    "inline tags join": ("<p>un<b>brok</b>en</p>", "unbroken"),
    "only a menu": ("<nav><a href=1>x</a></nav>", ""),
    "only a script": ("<script>x</script>", ""),
    "unclosed": ("<p>end <!-- never closed", "end"),
    "cut in a tag": ("<p>end <a href='x", "end"),
    "empty": ("", ""),
    "null": (None, ""),
    "deep": ("<div>" * 30000 + "deep text.", "deep text."),
    "many signs": ("<" * 100000, "<" * 100000),
    "long": ("<article>" + f"<p>{LOREM}</p>" * 20000, " ".join([LOREM] * 20000)),
}


def test_main_text(spark):
    rows = [(i, f"u{i}", page, "x", 7) for i, (page, _) in enumerate(PAGES.values())] + [(None, None, "<p>a</p>", "x", 7)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(3)
    got = main_text.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = got.collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for i, (name, (_, want)) in enumerate(PAGES.items()):
        assert (by_id[i].text, by_id[i].url, by_id[i].n_chars) == (want, f"u{i}", len(want)), name
    assert by_id[None].text == "a"
    assert main_text.extract(pages.filter("false")).count() == 0


def test_main_text_of_the_given_pages(spark):
    """The template of the test tables, read by pattern."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]).replace("<br>", " ")
        want[r.page_id] = " ".join(" ".join(html.unescape(x) for x in re.split("<[^>]*>", article)).split())
    assert {r.page_id: r.text for r in main_text.extract(pages).collect()} == want


# --- filter audit ----------------------------------------------------------------------------


def plain_audit(rows, labels):
    texts = [(i, t or "", s or "") for i, t, _, s, _ in rows]
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    failed = []
    for i, t, _ in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t))]
        bad.append(i is not None and any(j is not None and j < i and u == t for j, u, _ in texts))
        failed.append({"ABCDE"[k] for k in range(5) if bad[k]})
    out, removed = {}, {}
    for part in {s for _, _, s in texts}:
        mine = [(i, f) for (i, _, s), f in zip(texts, failed, strict=True) if s == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(mine)
            for step, k in enumerate(order, 1):
                lost = [x for x in left if k in x[1]]
                left = [x for x in left if k not in x[1]]
                all_k = [f for _, f in mine if k in f]
                removed[part, k] = removed.get((part, k), 0) + len(lost)
                out[part, order, step] = [len(left), len(lost), len(all_k) - len(lost), sum(f == {k} for f in all_k), sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost)]
    return {(p, o, s): (*v, removed[p, o[s - 1]]) for (p, o, s), v in out.items()}


def audit_rows():
    long_text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, [long_text, long_text + " #", "A b", "x " * 70, long_text.upper(), None, ""][i % 7], "en", ["s", None, "", "t"][i % 4], 1) for i in range(60)]
    rows += [(3, "A b", None, "s", None), (3, "A b", None, "s", None), (None, long_text, None, "t", None), (None, "only", None, "t", None), (200, "é " * 200_000 + long_text, "fr", "u", 1)]
    return rows, [(i, i % 2, i % 3 == 0) for i in range(0, 50, 3)] + [(3, 1, 1), (3, 0, None), (None, 1, 1), (999, 1, 1)]


@pytest.mark.parametrize("held", [filter_audit.HELD, 10])
def test_filter_audit(spark, monkeypatch, held):
    monkeypatch.setattr(filter_audit, "HELD", held)
    rows, labels = audit_rows()
    known = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs_of(spark, rows), known, owners=3)
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got.collect()} == plain_audit(rows, labels)
    assert filter_audit.audit(docs_of(spark, rows).filter("false"), known).count() == 0


def test_chains_keep_colliding_texts_apart():
    c = filter_audit.Chains()
    assert list(c.add(7, b"one", 0, 5, {"p": 1})) == []
    assert list(c.add(7, b"two", 0, 3, {"p": 1})) == []
    assert list(c.add(7, b"one", 0, 4, {"q": 2})) == [(5, "p", 16, 1)]
    assert list(c.add(7, b"two", 0, 3, {"q": 1})) == []
    assert list(c.add(7, b"two", 1, 9, {"q": 1})) == [(9, "q", 17, 1)]
    assert sorted(c.waiting()) == [(7, b"one", 0, 4, {"q": 2}), (7, b"two", 0, 3, {"p": 1, "q": 1})]


def test_filter_audit_sql(spark):
    import duckdb

    d = "/root/testdata/sf0.01"
    c = duckdb.connect()
    for t in ("documents", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    got = filter_audit.audit(*(spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels")))
    assert sorted(map(tuple, got.collect())) == sorted(c.sql(filter_audit.ORACLE).fetchall())


# --- manifest --------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves, fanout):
    levels = [leaves]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i : i + fanout])) for i in range(0, len(x), fanout)])
    return levels


def plain_siblings(levels, i, fanout):
    for x in levels[:-1]:
        run = i // fanout * fanout
        yield "".join(x[run:i]), "".join(x[i + 1 : run + fanout])
        i //= fanout


def plain_manifest(rows, fanout=2):
    rows = [(i, s, g, n, t) for i, t, g, s, n in rows]
    key = lambda r: (r[0] is not None, r[0], leaf(r))
    groups = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    members = {g: sorted((r for r in rows if r[2] == g), key=key) for g in groups}
    trees = {g: plain_tree([leaf(r) for r in members[g]], fanout) for g in groups}
    top = plain_tree([trees[g][-1][0] for g in groups], fanout)
    out = []
    for k, g in enumerate(groups):
        for i, r in enumerate(members[g]):
            around = [*plain_siblings(trees[g], i, fanout), *plain_siblings(top, k, fanout)]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node = leaf((*r[:3], r[3] + 1, r[4])) if hit else leaf(r)
            for a, b in around:
                node = sha(a + node + b)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in around)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def manifest_rows():
    rows = [(i, f"text {i}", ["en", "de", "", None, "é", "z"][min(i % 11, 5) if i % 3 else 0], f"s{i % 2}", i) for i in range(300)]
    return rows + [(1000, None, "one", None, None), (1001, "", "en", "", 0), (None, "x", "en", "s", 1), (None, None, "en", None, None), (7, "text 7", "en", "s1", 7), (7, "text 7", "en", "s1", 7), (-3, "é😀" * 100_000, "en", "s", 5)]


@pytest.mark.parametrize(("fanout", "levels"), [(2, 6), (2, 1), (3, 2)])
def test_manifest(spark, monkeypatch, fanout, levels):
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = manifest_rows() if levels > 1 else manifest_rows()[-18:]
    got = sorted(map(tuple, merkle.manifest(docs_of(spark, rows)).collect()), key=repr)
    assert got == plain_manifest(rows, fanout)
    assert {r[-1] for r in got} == {True, False}


def test_small_manifests(spark):
    for rows in ([(14, "a", "en", "s", 1)], [(14, "a", "en", "s", 1), (15, "a", None, "s", 1)], [(1, "a", None, None, None)] * 3):
        assert sorted(map(tuple, merkle.manifest(docs_of(spark, rows)).collect()), key=repr) == plain_manifest(rows)
    assert merkle.manifest(docs_of(spark, []).filter("false")).count() == 0


def test_manifest_sql(spark):
    import duckdb

    c = duckdb.connect()
    c.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    got = merkle.manifest(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert sorted(map(tuple, got.collect())) == sorted(c.sql(merkle.ORACLE).fetchall())


def test_the_entry_has_all_operators():
    import __spark_entry__ as entry

    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in entry.queries() if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert {"op3_exact_index", "op12_filter_audit", "op13_merkle"} <= set(entry.oracle_sql())

"""Each operator against a plain version of itself, with nulls, empty and repeated rows, and columns of clashing names."""

import collections
import hashlib
import itertools
import math
import pathlib
import random
import re
import tempfile
import time
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tessera.llm import _blocks, _shared, _trees, _words, exact_index, hyper_lang, katz, line_dedup, mixing, private_data, quality_rules, secret_scan, shingle_join, word_bpe
from tessera.llm._cores import stars

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words long, a long"


def docs_of(spark, rows):
    """rows: (doc_id, text[, lang, source]); the last columns clash with names that operators use."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, None, True, 7, 1) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3, "doc_id")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


ODD = [(None, "the of the"), (9001, None), (9002, ""), (9003, " \n\t "), (9004, "one"), (9004, "one"), (9005, "é 😀 x " * 3)]


def prose(seed, n, vocabulary=60):
    r = random.Random(seed)
    w = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(vocabulary)]
    return [(i, "\n".join(" ".join(r.choice(w) for _ in range(r.randint(1, 12))) for _ in range(r.randint(1, 8)))) for i in range(n)]


def base_statistics(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(ch in "[#*$%&|<>]"[1:-1] for ch in text or ""), dup, len(hit)


def test_quality_rules(spark):
    rows = prose(1, 80) + ODD + [(500 + i, "good words come here and there with no end in sight at all today or so they say " + "x " * i + " # " * (i % 3) * 20) for i in range(60)]
    rows += [(900, " ".join(f"w{i % 11}" for i in range(40))), (901, "a\na\na b\n\n\na b")]
    df = docs_of(spark, rows)
    labels = spark.createDataFrame([(500 + i, 0 if i % 3 else 1, 0) for i in range(60)] + [(None, 1, 0), (500, None, 0), (500, 1, 0)], "doc_id long, quality int, toxic int")
    rated = quality_rules.rate(df, labels).select("doc_id", "text", "_statistics.*").collect()
    assert len(rated) == len(rows)
    for r in rated:
        want = base_statistics(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in rated if r.kept}
    assert 503 in kept and 504 not in kept  # few and many symbols, as labelled
    out = quality_rules.keep(df, labels)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == kept
    assert quality_rules.rate(df.limit(0), labels.limit(0)).count() == 0
    assert quality_rules.rate(df, labels.limit(0)).filter("_statistics.rule > 0").count() == 0


def test_rule_learning():
    r = np.random.Generator(np.random.PCG64(1))
    x = {"a": r.random(600), "b": r.random(600)}
    bad = (x["a"] > 0.8) & (x["b"] <= 0.5)
    rules = quality_rules.learn(x, bad)
    held = np.zeros(600, bool)
    for rule in rules:
        held |= rule.holds(x, 600)
    assert (held == bad).mean() > 0.97


def katz_by_rule(rows, order, new=()):
    """Plain model: counts by n-gram, probabilities by recursion. rows are learned from unless held out; rows and new ones are scored."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda s: re.findall(rb"[^\x20\x09-\x0D]+", (s or "").encode().lower()) + [b""]
    grams = lambda w, n: list(zip(*[([b""] * (n - 1) + w)[i:] for i in range(n)]))
    c = {n: collections.Counter(g for i, s in rows if not held(i) for g in grams(tokens(s), n)) for n in range(1, order + 1)}
    u = {g[0]: x for g, x in c[1].items()}
    total, v = sum(u.values()), len(u)
    d = {n: katz.discounts([sum(x == r for x in c[n].values()) for r in range(katz.K + 2)]) for n in c}
    less = lambda n, x: d[n][x] * x if x <= katz.K else x
    unseen = 1 - sum(less(1, x) for x in u.values()) / total
    after = collections.defaultdict(dict)
    for n in range(2, order + 1):
        for g, x in c[n].items():
            after[g[:-1]][g[-1]] = x
    cache = {}

    def p(h, w):
        if not h:
            return less(1, u[w]) / total if w in u else unseen
        if h not in after:
            return p(h[1:], w)
        n = len(h) + 1
        if h not in cache:
            seen, used = sum(after[h].values()), sum(less(n, x) for x in after[h].values())
            whole = seen + (used >= seen - 1e-9)
            cache[h] = (1 - used / whole) / (1 - sum(p(h[1:], x) for x in after[h])), whole
        x = after[h].get(w, 0)
        return less(n, x) / cache[h][1] if x else cache[h][0] * p(h[1:], w)

    for h in [(b"",) * (order - 1), *list(after)[:: 1 + len(after) // 20]]:
        assert abs(sum(p(h, w) for w in u) + p(h, b"\0") - 1) < 1e-9
    out = []
    for i, s in [*rows, *new]:
        w = tokens(s)
        out.append((i, held(i), len(w), sum(x in u for x in w), total, sum(math.log10((u.get(x, 0) + 0.5) / (total + 0.5 * (v + 1))) for x in w), sum(math.log10(p(g[:-1], g[-1])) for g in grams(w, order))))
    return out


def same_scores(got, want):
    got, want = sorted(map(tuple, got), key=repr), sorted(want, key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_katz(spark, monkeypatch, order):
    monkeypatch.setattr(_blocks, "BLOCK", 1500)
    rows = prose(2, 120) + [(r[0], r[1]) for r in ODD] + [(9100, "Only here " * 3)]
    same_scores(katz.fit_score(docs_of(spark, rows), order=order).collect(), katz_by_rule(rows, order))


def test_katz_model_scores_other_texts(spark, monkeypatch):
    monkeypatch.setattr(_blocks, "BLOCK", 1500)
    rows = prose(2, 90) + [(r[0], r[1]) for r in ODD]
    new = [(20_000 + i, t) for i, t in prose(3, 30)] + [(20_100, rows[5][1]), (20_101, None), (20_102, "never seen " + rows[7][1]), (None, "")]
    model = katz.fit(docs_of(spark, rows))
    got = model.score(docs_of(spark, new)).collect()
    assert all(r.held_out for r in got)
    same_scores(got, [(w[0], True, *w[2:]) for w in katz_by_rule(rows, katz.ORDER, new)[len(rows) :]])
    assert katz.fit_score(docs_of(spark, rows).limit(0)).count() == 0
    assert [r.score for r in katz.fit(docs_of(spark, rows).limit(0)).score(docs_of(spark, [(1, "a b")])).collect()] == [0.0]


def test_katz_numbers_ngrams_without_sorting_places(monkeypatch):
    r = np.random.default_rng(3)
    for tops in ([5], [7, 300_000], [1 << 20, 1 << 28], [1 << 40, 1 << 24], [1 << 40, 1 << 30], [1 << 63, 3, 9]):
        rows = [np.concatenate([x := r.integers(0, t, 500).astype(np.uint64), x]) for t in tops]
        number, first = _words.distinct(*rows)
        want, inverse = np.unique(np.column_stack(rows), axis=0, return_inverse=True)
        assert (np.column_stack(rows)[first] == want).all() and (number == inverse.reshape(-1)).all()
        assert [len(x) for x in _words.distinct(*[x[:0] for x in rows])] == [0, 0]
    slow = lambda *a, **k: pytest.fail("sorts places")
    block = _blocks.Block(8, True, True)
    for i, t in prose(5, 40):
        block.add(i, t.encode(), i % 5 == 1)
    row, *asked = [dict(zip(("block", "bucket", "stamp", "words", "tokens"), x, strict=True)) for x in block.rows(0)]
    counted = [katz.count_words(pa.Table.from_pylist([x]), 8, False) for x in asked]
    found = pa.concat_tables([x.filter(pc.not_equal(x["block"], katz.MODEL)) for x in counted])
    model = katz.Model(8, katz.Unigrams.of(500, 60, [0, 9, 5, 3, 2, 1, 1]))
    with monkeypatch.context() as m:
        m.setattr(np, "lexsort", slow)
        m.setattr(np, "unique", slow)
        requests = katz._asking(2, model, 0, 1)(pa.Table.from_pylist([row]), found)
        for b in range(requests.num_rows):
            katz.count_grams(requests.slice(b, 1), 2, model.lower(), False)
    assert requests.num_rows


def test_katz_scores_without_tables_of_a_model(spark, monkeypatch):
    tables = {}

    def stored(df, name):
        tables[name] = _shared.stored(df, name)
        return tables[name]

    monkeypatch.setattr(katz, "stored", stored)
    katz.fit_score(docs_of(spark, prose(2, 30))).count()
    assert sorted(tables) == ["katz-1", "katz-2", "katz-3"]
    for x in tables.values():
        assert x.filter("block < 0").count() and not x.filter("block < 0 and length(answer) > 0").count()


def test_stored_leaves_no_shuffle_files(spark):
    name, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    had = spark.conf.get(name)
    with _shared.shuffles_removed(spark):
        seen.append(spark.conf.get(name))
    assert seen == ["true"] and spark.conf.get(name) == had
    files = lambda: sum(1 for x in pathlib.Path(tempfile.gettempdir()).glob("**/blockmgr-*/**/shuffle_*.data"))
    before = files()
    _shared.stored(spark.range(1000).repartition(3, "id"), "few")  # counting it would make a shuffle of its own
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before


def test_word_bpe_makes_its_tokenizer_once():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    assert word_bpe._tokenizer(definition) is word_bpe._tokenizer(definition)


def test_line_keys_with_classes_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def key(i):
        made.add(1)
        return i % 3

    t = spark.range(30).select(F.col("id").alias("line"), F.udf(key, "long")("id").alias("key"))
    classes = spark.createDataFrame([(i, 0) for i in range(0, 30, 3)], "node long, component long")
    got = line_dedup._with_classes(t, classes, 10)
    assert sorted(r.line for r in got.collect()) == [i for i in range(30) if i % 3] and made.value == 30


def test_discounts_stay_in_range():
    for n in ([0, 5, 3, 2, 1, 1, 1], [0, 0, 0, 0, 0, 0, 0], [0, 7, 0, 0, 0, 0, 0], [0, 1, 9, 1, 9, 1, 9]):
        assert all(0 < x < 1 for x in katz.discounts(n)[1:])


def test_exact_index(spark):
    rows = prose(3, 40) + ODD + [(50 + i, "Same TEXT É" if i % 2 else "same text É") for i in range(30)] + [(99, "same text é"), (None, "same text É"), (None, "alone")]
    got = exact_index.classes(docs_of(spark, rows), capacity=5).collect()
    lower = lambda s: (s or "").translate({c: c + 32 for c in range(65, 91)})
    groups = collections.defaultdict(list)
    for i, s in rows:
        groups[hashlib.sha256(lower(s).encode()).hexdigest()].append(i)
    assert len(got) == len(rows) and len({r.bucket for r in got}) > 4
    for r in got:
        ids = groups[r.text_sha256]
        best = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (best, len(ids), r.doc_id == best)
    assert exact_index.classes(docs_of(spark, rows).limit(0)).count() == 0


def test_chains_of_equal_hashes(spark, monkeypatch):
    """Different texts with one hash: in a bucket's chain, and among those collapsed before."""
    monkeypatch.setattr(exact_index, "key_hash", lambda t: F.length(t).cast("long"))
    rows = [(i, "abcd"[i % 4] * (1 + i % 5)) for i in range(60)]
    for capacity in (3, 1000):
        got = exact_index.classes(docs_of(spark, rows), capacity=capacity).collect()
        assert len(got) == 60
        for q in got:
            same = [i for i, s in rows if hashlib.sha256(s.encode()).hexdigest() == q.text_sha256]
            assert q.doc_id in same and (q.keep_id, q.group_size, q.kept) == (max(same), len(same), q.doc_id == max(same))


def test_split_directory():
    d = exact_index.split_directory({0: 10, 1: 1, 2: 1, 3: 1}, 2, 5)
    assert d == [(2, 0), (2, 1), (1, 1)]


def test_hyper_lang(spark):
    r = random.Random(4)
    make = lambda syllables: " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(40))
    langs = {"en": ["th", "ing", "er", "an", "ou"], "de": ["sch", "ung", "ei", "ü", "ge"], "fr": ["eau", "é", "que", "oi", "ai"]}
    rows = [(3 * i + k, make(s), lang) for i in range(60) for k, (lang, s) in enumerate(langs.items())]
    odd = [(None, make(langs["de"]), "de"), (9001, None, "en"), (9002, "12 !", "fr"), (9003, "日本 😀", None)]
    got = hyper_lang.identify(docs_of(spark, rows + odd)).collect()
    true = {i: lang for i, _, lang in rows}
    held = [x for x in got if x.held_out and x.doc_id in true]
    assert {x.doc_id for x in held} == {i for i in true if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(x.lang_pred == true[x.doc_id] for x in held) >= 0.95 * len(held)
    by = {x.doc_id: x for x in got}
    assert by[9001].lang_pred == by[9002].lang_pred == "und" and by[9002].score == 0 and by[None].lang_pred == "de"
    assert by[9003].lang_pred in langs and all(0 <= x.score <= 1 for x in got)
    assert {x.lang_pred for x in hyper_lang.identify(docs_of(spark, odd[2:])).collect()} == {"und"}


def test_word_bpe(spark, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(_blocks, "BLOCK", 2000)
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = prose(5, 60) + ODD + [(800, "I'm<|endoftext|>x  <|startoftext|> ́a İΣς don't 12\x1c3 y")]
    df = docs_of(spark, rows)
    want = sorted((i, t.encode(s or "", add_special_tokens=False).ids) for i, s in [(r[0] if r[0] is not None else -1, r[1]) for r in rows])
    enc = word_bpe.encode(df, path)
    assert sorted((r.doc_id if r.doc_id is not None else -1, list(r.ids)) for r in enc.collect()) == want
    for r in word_bpe.decode(enc, path).collect():
        assert r.decoded == t.decode(list(r.ids), skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in word_bpe.digests(df, path).collect())
    assert digests == sorted((i, len(x), sha(" ".join(map(str, x))), sha(t.decode(x, skip_special_tokens=False))) for i, x in want)
    assert word_bpe.digests(df.limit(0), path).count() == 0
    odd = spark.createDataFrame([([1, -5, 10**6, 2],), ([],), (None,)], "ids array<int>")
    assert [r.decoded for r in word_bpe.decode(odd, path).collect()] == [t.decode([1, 2], skip_special_tokens=False), "", ""]


def test_shingle_join_groups_and_batches_are_bounded(spark, monkeypatch):
    """More shingles get more buckets, and Python tasks get batches by bytes; the session's own bound comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    had, seen = spark.conf.get(name), []
    index, compare = shingle_join.index_keys, shingle_join.similar
    monkeypatch.setattr(shingle_join, "BUCKET_SHINGLES", 40)
    monkeypatch.setattr(shingle_join, "index_keys", lambda docs, plan, width, buckets: seen.append(buckets) or index(docs, plan, width, buckets))
    monkeypatch.setattr(shingle_join, "similar", lambda *a: seen.append(spark.conf.get(name)) or compare(*a))
    rows = [(k, " ".join(f"w{k // 2}_{i}" for i in range(60)) + f" end{k}") for k in range(40)]
    got = {g.doc_id: (g.n_shingles, g.component_id) for g in shingle_join.link_documents(docs_of(spark, rows)).collect()}
    assert got == {k: (57, k // 2 * 2) for k in range(40)}
    assert seen[0] == 40 * 57 // 40 and set(seen[1:]) == {str(shingle_join.BATCH)} and spark.conf.get(name) == had


def shingles(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("few", [2, 16])
def test_shingle_join(spark, monkeypatch, few):
    """few = 2 makes nearly every shared key a frequent one, so the pairs come by way of the second pass; once without leaders."""
    monkeypatch.setattr(shingle_join, "FEW", few)
    monkeypatch.setattr(shingle_join, "ROUNDS", 0 if few == 2 else 2)
    monkeypatch.setattr(shingle_join, "BLOCK", 3000)
    r = random.Random(6)
    base = [[f"w{r.randint(0, 400)}" for _ in range(n)] for n in (6, 9, 14, 40, 45, 90, 260)]
    rows = []
    for k in range(150):
        w = list(r.choice(base))
        for _ in range(r.randint(0, max(1, len(w) // 14))):
            w[r.randrange(len(w))] = f"x{r.randint(0, 9)}"
        rows.append((k, " ".join(w[: len(w) - r.randint(0, 2)])))
    common = " ".join(f"c{i}" for i in range(30))
    rows += [(200 + k, common + " " + " ".join(f"u{k}_{i}" for i in range(r.randint(5, 60)))) for k in range(40)]
    rows += [(r[0], r[1]) for r in ODD] + [(300, "A b"), (301, "a B"), (None, rows[3][1])]
    got = shingle_join.link_documents(docs_of(spark, rows)).collect()
    sets = collections.defaultdict(list)
    for i, s in rows:
        sets[i].append(shingles(s))
    parent = {i: i for i in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(parent)
    for i, x in enumerate(ids):
        for y in ids[:i]:
            if any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[x] for b in sets[y]):
                p, q = root(x), root(y)
                parent[max(p, q)] = min(p, q)
    assert len(got) == len(rows)
    for g in got:
        assert g.n_shingles in {len(s) for s in sets[g.doc_id]}
        assert g.component_id == (None if g.doc_id is None else root(g.doc_id))
    kept = shingle_join.keep_one(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, []).columns
    assert {x.doc_id for x in kept.collect()} == {i for i in parent if root(i) == i} | {None}
    assert shingle_join.link_documents(docs_of(spark, rows).limit(0)).count() == 0


def test_rarest_keys_need_enough_after_them(spark):
    """Documents meet by the first key that they share only if both have enough keys from there on; all that may link do."""
    sets = {1: range(1, 11), 2: [3, *range(11, 20)], 3: range(30, 40), 4: range(30, 40), 5: range(31, 41)}
    shared = spark.createDataFrame([(i, k, 2) for i, ks in sets.items() for k in ks], "id long, k long, df long")
    documents = spark.createDataFrame([(i, 10, 10, i, 10, 8) for i in sets], "id long, n long, high long, component long, h long, least long")
    got = {(x.a, x.b) for x in shingle_join._rarest(documents, shared, len(sets), 3, 4).collect()}
    assert got == {(3, 4), (3, 5), (4, 5)}


def test_texts_join_alike_at_every_size(spark):
    """What texts are joined with doesn't go through the driver, however little it is."""
    df = docs_of(spark, [(k, f"line {k} of some words\nthe same line in all of them") for k in range(20)])
    for out in (line_dedup.dedup(df), mixing.sample(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_partition_plan_holds():
    """Any two sets of the wanted similarity share a key of a part."""
    r = np.random.Generator(np.random.PCG64(7))
    plan = shingle_join.Plan.of(3, 4, 2000)
    for size in (1, 2, 3, 4, 7, 24, 25, 33, 60, 150, 700):
        for _ in range(20):
            a = r.integers(0, 1 << 63, size, dtype=np.uint64)
            drop = r.integers(0, size // 7 + 1)
            b = np.concatenate([a[drop:], r.integers(0, 1 << 63, r.integers(0, size // 7 + 1), dtype=np.uint64)])
            if len(b) and 4 * len(np.intersect1d(a, b)) >= 3 * len(np.union1d(a, b)):
                h = np.concatenate([np.sort(a), np.sort(b)])
                key, of, own, _, full, worth = shingle_join.part_keys(h, np.array([0, len(a), len(h)]), plan)
                assert set(key[of == 0].tolist()) & set(key[of == 1].tolist())


def edits(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def changed(r, s, k):
    s = list(s)
    for _ in range(k):
        i, how = r.randrange(len(s) + 1), r.choice("ids")
        if how == "i":
            s.insert(i, r.choice("abc é"))
        elif i < len(s):
            s[i : i + 1] = [] if how == "d" else [r.choice("abcd")]
    return "".join(s)


def test_fine_keys_hold(spark):
    """Lines within two edits share two of four segments, at least one of them unmoved."""
    r = random.Random(18)
    rows = []
    for k in range(600):
        x = "".join(r.choice("abcdefgh é") for _ in range(r.randint(12, 60)))
        y = changed(r, x, 2 if min(len(x), 26) >= 26 else 1)
        if edits(x, y) <= (2 if min(len(x), len(y)) >= 24 else 1) and min(len(x), len(y)) >= 12:
            rows.append((k, x, y))
    def keys(c):
        return F.concat(*[F.when(here, line_dedup.fine_keys(F.col(c), k)).otherwise(F.array().cast("array<struct<key:bigint,moved:int,kind:int,x1:bigint,x2:bigint,x3:bigint>>")) for k, (_, _, here) in enumerate(line_dedup.bands(F.length(c)))])

    chars = lambda c: line_dedup.sketch(F.split(c, ""))
    df = spark.createDataFrame(rows, "k int, x string, y string").select("x", "y", keys("x").alias("a"), keys("y").alias("b"), chars("x").alias("u"), chars("y").alias("v"))
    for q in df.collect():
        assert sum(((i ^ j) & (1 << 64) - 1).bit_count() for i, j in zip(q.u, q.v)) <= (8 if min(len(q.x), len(q.y)) >= 24 else 4)
        assert {i.key for i in q.a if not i.moved} & {i.key for i in q.b} or {i.key for i in q.b if not i.moved} & {i.key for i in q.a}, (q.x, q.y)


@pytest.mark.parametrize("few", [1, 32])
def test_line_dedup(spark, monkeypatch, few):
    """few = 1 makes every shared segment a frequent one."""
    monkeypatch.setattr(line_dedup, "FEW", few)
    r = random.Random(8)
    base = ["".join(r.choice("abcé d") for _ in range(r.randint(1 + 20 * (k % 4 > 0), 25 + 45 * (k % 4 > 0)))) for k in range(40)]
    pairs = [(changed(r, b, r.randint(0, 3)), b) for b in base * 6]
    pairs = spark.createDataFrame([(x, y, list(x), list(y)) for x, y in pairs if abs(len(x) - len(y)) <= 2], "x string, y string, a array<string>, b array<string>")
    for q in pairs.select("x", "y", line_dedup.within(F.col("a"), F.col("b"), 2).alias("near")).collect():
        assert q.near == (edits(q.x, q.y) <= 2)
    rows = [(i, "\n".join(changed(r, r.choice(base), r.choice([0, 0, 1, 2, 3])) for _ in range(r.randint(0, 6)))) for i in range(120)]
    rows += [(None, base[0]), (900, None), (901, ""), (902, base[1] + "\n\n" + base[1]), (903, " \n")]
    at = collections.defaultdict(list)
    for i, s in rows:
        for p, line in enumerate((s or "").split("\n")):
            if i is not None and words(line):
                at[line].append((i, p))
    lines = list(at)
    parent, links = {x: x for x in lines}, collections.Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(lines):
        for y in lines[:i]:
            tau = 2 if min(len(x), len(y)) >= 24 else int(min(len(x), len(y)) >= 12)
            if tau and abs(len(x) - len(y)) <= tau and edits(x, y) <= tau:
                links.update([x, y])
                parent[root(x)] = root(y)
    first = {}
    for x in lines:
        first[root(x)] = min(first.get(root(x), (1 << 60, 0)), min(at[x]))
    df = docs_of(spark, rows)
    got = {q.doc_id: q for q in line_dedup.report(df).collect()}
    text = {q.doc_id: q.text for q in line_dedup.dedup(df).collect()}
    assert len(got) == len(rows) and sum(links.values()) > 20
    for i, s in rows:
        if i is None:
            assert text[i] == s
            continue
        ls = (s or "").split("\n")
        held = [(p, x) for p, x in enumerate(ls) if words(x)]
        gone = [p for p, x in held if first[root(x)] != (i, p)]
        assert (got[i].n_lines, got[i].n_kept, got[i].n_near) == (len(held), len(held) - len(gone), sum(links[x] > 0 for _, x in held))
        if held and len(gone) == len(held):
            assert i not in text
        else:
            assert text[i] == (None if s is None else "\n".join(x for p, x in enumerate(ls) if p not in gone))
    assert line_dedup.report(df.limit(0)).count() == 0 and line_dedup.dedup(df.limit(0)).count() == 0


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def test_clashing_names(spark):
    """Columns named as inner ones, in any case, stay as they were; so do rows with null ids and repeated rows."""
    extra = ["_id", "_DROPPED", "_gone", "_times", "_Copy", "_statistics", "_private", "_secrets"]
    line = "the same line of more than twenty characters"
    rows = [(1, f"{line}\nanother one"), (2, line), (3, "call me at a@b.example today"), (3, "call me at a@b.example today"), (None, line), (4, None)]
    df = docs_of(spark, rows).select("doc_id", "text", F.lit("s").alias("source"), *[F.lit(c).alias(c) for c in extra])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    outs = {"lines": line_dedup.dedup(df), "mix": mixing.sample(df), "rules": quality_rules.keep(df, labels), "private": private_data.redact(df)}
    for name, out in outs.items():
        got = out.collect()
        assert out.columns == df.columns, name
        assert all(q[c] == c for q in got for c in extra), name
    assert sorted((q.doc_id or 0, q.text or "") for q in outs["lines"].collect()) == [(0, line), (1, f"{line}\nanother one"), *[(3, "call me at a@b.example today")] * 2, (4, "")]
    assert [q.text for q in outs["private"].filter("doc_id = 3").collect()] == ["call me at [EMAIL] today"] * 2


def template_lines(seed):
    """Lines of one head and tail: of few letters, of two fields, of one long field, and with repeats inside; long and short ones."""
    r = random.Random(seed)
    head, tail = "the header of every page of this report says ", " and it ends with the same remark"
    out = [head + "".join(r.choice("ab") for _ in range(r.choice((11, 12, 12, 13)))) + tail for _ in range(60)]
    out += [f"{head}{r.choice(('north', 'south', 'eastern'))} has {r.randint(0, 9)}{r.randint(0, 9)} rows of {r.choice('xyz')}{r.randint(0, 99)} seen {tail}" for _ in range(80)]
    out += [head + "".join(r.choice("aé ") for _ in range(r.randint(2, 6))) + tail for _ in range(60)]
    out += ["line no. " + "".join(r.choice("0123") for _ in range(r.randint(4, 6))) for _ in range(60)]
    # Substrings of one text, so that segments stand at several places.
    return sorted({*out, *[head + "abab" * r.randint(3, 6) + r.choice(("", "x", "ba")) + "abab" * r.randint(0, 3) + tail for _ in range(40)]})


@pytest.mark.parametrize("most", [2, 20, 128])
def test_lines_of_templates(spark, monkeypatch, most):
    """Two of four segments that many lines share: classes as by brute force, whatever the bound on pairs."""
    monkeypatch.setattr(line_dedup, "FEW", 2)
    monkeypatch.setattr(line_dedup, "MOST", most)
    lines = template_lines(21)
    parent = list(range(len(lines)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(lines):
        for j, y in enumerate(lines[:i]):
            tau = 2 if min(len(x), len(y)) >= 24 else 1
            if abs(len(x) - len(y)) <= tau and edits(x, y) <= tau:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    got = {q.doc_id: q.n_kept for q in line_dedup.report(docs_of(spark, list(enumerate(lines)))).collect()}
    assert got == {i: int(root(i) == i) for i in range(len(lines))}
    assert 20 < sum(got.values()) < len(lines) - 20


def test_stars_connect(spark):
    """Short cores: stars alone give the components that all pairs within tau give."""
    cores = ["".join(x) for n in range(4) for x in itertools.product("ab", repeat=n)][1:] + ["\n", "a\n", "b\na", "\nccdd", "ccdde", "ffccdde", "ghiccdd"]
    for tau in (1, 2):
        rows = [(1, tau, i, i, c) for i, c in enumerate(cores)]
        pairs = {(q.a, q.b) for q in stars(spark.createDataFrame(rows, "key long, tau int, line long, class long, r string")).collect()}

        def joined(links):
            label = list(range(len(cores)))
            for a, b in sorted(links):
                low, high = sorted((label[a], label[b]))
                label = [low if k == high else k for k in label]
            return label

        # A mark counts as a character that no edit touches.
        near = {(i, j) for j, y in enumerate(cores) for i, x in enumerate(cores[:j]) if x.count("\n") == y.count("\n") and sum(edits(p, q) for p, q in zip(x.split("\n"), y.split("\n"), strict=True)) <= tau}
        assert joined({p for p in pairs if p in near}) == joined(near)
        assert pairs <= near


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = re.sub(r"\D", "", m[0])
            check = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and check % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{e}" for a, _, e, kind in sorted(out))


def test_private_data(spark):
    r = random.Random(9)
    alphabet = ["1", "4", "0", "9", ".", "@", "a", "b.c", "+", " ", "-", "(", "%", "_", "4111 1111 1111 1111", "10.0.0.1", "x@y.z", "+1 (017) 555-7713", "é", "😀"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(400)]
    texts += [None, "", "a@b.c_x@y.z 1.2.3.4.5.6.7.8 999.1.1.1", "000255.01.2.3 a@b.c.d@e.f", "mail bob (at) site [dot] com or phone 555-123-4567", "order 123-456-789"]
    df = docs_of(spark, list(enumerate(texts)) + [(None, "x@y.z")])
    for q in private_data.report(df).join(df.select(F.col("doc_id").alias("i"), "text"), F.col("doc_id").eqNullSafe(F.col("i"))).collect():
        want = base_spans(q.text or "")
        assert q.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [q.n_email, q.n_ip, q.n_card, q.n_phone] == [want.count(k + ":") for k, _ in PATTERNS]
        assert set(filter(None, want.split(","))) <= set(q.spans.split(","))
    clean = {q.doc_id: q.text for q in private_data.redact(df).collect()}
    assert clean[len(texts) - 2] == "mail [WRITTEN] or phone [LOCAL]" and clean[len(texts) - 6] is None
    many = "a@b.cd, 10.0.0.7; " * 2000
    rows = [(1, "bob at site" + " dot abc" * 3000), (2, many), (3, "call 555-123-4567 or " * 1500)]
    got = {q.doc_id: q for q in private_data.report(docs_of(spark, rows)).collect()}
    assert got[1].n_spans <= 1 and (got[2].n_email, got[2].n_ip) == (2000, 2000) and got[3].n_spans > 0
    assert got[2].base_sha256 == hashlib.sha256(base_spans(many).encode()).hexdigest()
    long = docs_of(spark, [(1, "9" * 30_000 + " " + "a" * 30_000 + "@x " + "1." * 5_000)])
    assert private_data.report(long).first().n_card == 0


#: Findings and look-alikes written for the test: none of these phrases stands in a training table.
FINDINGS = {
    "written": (
        ["my box is %s thanks", "ping %s please", "%s is where I read", "sign up through %s today"],
        ["lena.voss (at) posthaus (dot) de", "tim99[at]acme[dot]org", "noor at rivermail dot com", "j.roe {at} uni {dot} edu", "kai (at) foo (dot) co (dot) uk"],
        ["he looked at night dot moon", "stop at every dot there", "point at each dot pattern"],
    ),
    "local": (
        ["dial %s after six", "my number is %s ok", "text %s soon", "%s belongs to Anna"],
        ["(312) 555-0149", "0171 555 8834", "646-555-0172", "020/555 9123", "0221.555.0199"],
        ["118.20.31", "204-611-930", "310 224 887 590", "02/11-2024", "771-2203-4410"],
    ),
    "number": (
        ["social %s on file", "holder of %s said", "national insurance %s noted", "her passport, %s, expired"],
        ["219-09-9999", "DE89 3704 0044 0532 0130", "C01234567", "GB29 6016 1331 9268 1944"],
        ["PN12345678901234", "PR1234567", "V123456", "ZX55000011112222"],
    ),
    "account": (
        ["he gave %s to the clerk", "billed to %s again", "the plastic says %s here", "note %s down"],
        ["4929 1234 5678 9013", "5312-8876-1290-4461", "9807915762804490", "4716258050958646"],
        ["20240131123000", "9783161484101", "1111111111111111", "1784563920184756201", "10 20 30 40 50 60 70"],
    ),
}


def test_private_data_finds_more(spark):
    rows, want = [], {}
    for kind, (phrases, good, bad) in FINDINGS.items():
        for values, true in ((good, True), (bad, False)):
            for phrase, value in itertools.product(phrases, values):
                want[len(rows)] = (kind, true, phrase.index("%s"), len(value))
                rows.append((len(rows), phrase % value))
    got = {r.doc_id: r for r in private_data.report(docs_of(spark, rows)).collect()}
    for kind in FINDINGS:
        mine = [(i, w) for i, w in want.items() if w[0] == kind]
        hit = {i for i, w in mine if f"{kind}:{w[2]}:{w[2] + w[3]}" in got[i].spans.split(",")}
        base = {i for i, w in mine if got[i].n_card}  # a number may pass its check sum by chance: then it is a base span
        true = {i for i, w in mine if w[1]}
        assert len(hit & true) >= 0.9 * len(true - base), kind
        assert len(hit & true) >= 0.9 * len(hit), kind


def test_thresholds():
    score, y = np.array([0.9, 0.9, 0.8, 0.8, 0.7, 0.2]), np.array([1, 1, 1, 0, 1, 0])
    assert _trees.threshold(score, y, 1.0) == pytest.approx(0.85)  # half of a score's rows are not taken
    assert _trees.threshold(score, y, 0.8) == pytest.approx(0.45)
    assert _trees.threshold(score, 1 - y, 0.9) == 1.0
    assert _trees.threshold(score[:0], y[:0], 0.9) == 1.0


def test_secret_scan(spark):
    key = "9c8b45435718dcc700c184a7e30f60a7fa07e990"
    rows = [(1, f'x token = "{key}" y'), (2, f"commit {key} merged"), (3, "plain words only, thebleeainonthingandthether"), (4, None), (5, ""), (None, "api_key: ghp_" + "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bD1fG3hJ5")]
    got = {q.doc_id: q for q in secret_scan.report(docs_of(spark, rows)).collect()}
    assert [got[i].n_secrets for i in (1, 2, 3, 4, 5, None)] == [1, 0, 0, 0, 0, 1]
    start, end = map(int, got[1].secrets.split(":")[1:])
    assert key in rows[0][1][start:end]
    pieces = "a1B2" * 500  # longer than one candidate
    assert secret_scan.report(docs_of(spark, [(1, pieces)])).count() == 1


def test_secret_candidates_cover_whole_values(spark):
    jwt = ["eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", "eyJzdWIiOiIxMjM0NTY3ODkwIiwibmFtZSI6IkpvaG4gRG9lIn0", "SflKxwRJSMeKKF2QT4fwpMeJf36POk6yJV_adQssw5c"]
    hook, key = "aB3dE5gH7jK9mN1pQ3sT5vW7", "9c8b45435718dcc700c184a7e30f60a7fa07e990"
    rows = [("x " + "a1B2" * 500, ["a1B2" * 500]), ("Bearer " + ".".join(jwt), jwt), (f"see https://hooks.example.com/services/T0A1B2C3D/B4E5F6G7H/{hook} now", [hook])]
    rows += [(f"ends here.{key}", [key]), ("token = '" + "a!B2" * 400 + "'", ["a!B2" * 400]), ("é😀 " + "A" * 511 + "." + "b1" * 300, ["A" * 511, "b1" * 300])]
    df = docs_of(spark, [(i, t) for i, (t, _) in enumerate(rows)])
    got = {r.doc_id: r.p for r in df.select("doc_id", secret_scan.proposals(F.col("text")).alias("p")).collect()}
    for i, (text, parts) in enumerate(rows):
        assert all(text[x.start : x.end] == x.text for x in got[i])
        for part in parts:
            at = text.index(part)
            assert any(x.start <= at and at + len(part) <= x.end for x in got[i]), (i, part)
    assert all(r.n_candidates >= len(rows[r.doc_id][1]) for r in secret_scan.report(df).collect())


def water_level(sizes, weights, share=1.5, cap=2.0):
    target, left = dict.fromkeys(sizes, 0.0), set(sizes)
    rest = share * sum(sizes.values())
    while left:
        level = rest / sum(weights[s] for s in left)
        full = {s for s in left if level * weights[s] > cap * sizes[s]}
        if not full:
            return target | {s: level * weights[s] for s in left}
        for s in full:
            target[s] = cap * sizes[s]
            rest -= target[s]
        left -= full
    return target


def test_mixing(spark):
    r = random.Random(10)
    rows = [(i, " ".join("w" for _ in range(r.randint(0, 60))), None, r.choice(["b", "a", "Z", "é", None, "c", "c", "c"])) for i in range(1500)]
    rows += [(None, "x y", None, "a"), (5000, None, None, "a"), (5001, "one two", None, "empty\u0000"), (5002, "", None, "none")]
    df = docs_of(spark, rows)
    got = mixing.mix(df, shard_words=3000).collect()
    again = mixing.mix(df.repartition(5), shard_words=3000).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    target = water_level(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    source = {r[0]: r[3] for r in rows}
    taken = collections.Counter()
    for g in got:
        s = source[g.doc_id]
        assert g.source_size == sizes[s] and g.target == pytest.approx(target[s]) and 0 <= g.taken <= 2 * g.size
        taken[s] += g.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 2 * mixing.BLOCK
    out = mixing.sample(df)
    assert out.columns == df.columns and out.filter("doc_id is null").count() == 1
    assert mixing.mix(df.limit(0)).count() == 0


def test_apportionment(spark):
    r = random.Random(11)
    rows = [(g, i, float(r.choice([0, 1, 5, 40, 300]) * r.random())) for g in range(6) for i in range(1 + g * 3)]
    seats = 37
    got = mixing.apportion(spark.createDataFrame(rows, "g int, i int, votes double"), ["g"], "votes", F.lit(seats), [F.col("i")]).collect()
    for g in range(6):
        votes = {i: v for gg, i, v in rows if gg == g}
        if not sum(votes.values()):
            continue
        have = dict.fromkeys(votes, 0)
        for _ in range(seats):
            best = max(votes, key=lambda i: (votes[i] / (2 * have[i] + 1), -i))
            have[best] += 1
        assert {x.i: x.quota for x in got if x.g == g} == have


def test_chunks_make_few_objects_at_once():
    import tracemalloc

    texts = pa.array([f"{i} " + "x" * 2000 if i % 7 else None for i in range(5000)], pa.string())
    tracemalloc.start()
    got = [(first, len(some), some[0]) for first, some in _words.chunks(texts, 64 << 10)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 << 20 and sum(n for _, n, _ in got) == 5000
    assert [(f, s) for f, _, s in got] == [(f, (texts[f].as_py() or "").encode()) for f, _, _ in got]


def test_pipeline_encodes_in_small_blocks(spark, monkeypatch):
    """The last stage's batches and blocks are small, with the same digests, and its table outlasts the next run's first stage."""
    import corpus_pipeline
    import public_tokenizers

    docs = spark.createDataFrame([*prose(9, 300), *ODD], "doc_id long, text string").coalesce(1)
    assert corpus_pipeline.BATCH <= corpus_pipeline.BLOCK < _blocks.BLOCK
    want = sorted(map(str, word_bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json")).collect()))
    monkeypatch.setattr(corpus_pipeline, "BLOCK", 5000)
    cut = []
    to_blocks = _blocks.to_blocks
    monkeypatch.setattr(word_bpe, "to_blocks", lambda *a, **k: cut.append((k["size"], spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))) or to_blocks(*a, **k))
    got = corpus_pipeline.encode(spark, docs, "")
    assert cut == [(5000, str(corpus_pipeline.BATCH))] * 2
    assert _blocks.block_documents(to_blocks(docs.selectExpr("doc_id AS id", "text", "false AS flag"), 8, False, False, "documents", 5000)).count() > 5
    corpus_pipeline.stage(lambda spark, docs, sf_dir: docs)(spark, docs, "")
    assert sorted(map(str, got.collect())) == want


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, d), "test")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        sizes.append(out.count())
        docs = out
    assert sizes[0] < spark.read.parquet(f"{d}/documents.parquet").count() and sizes[-1] == sizes[-2]
    assert corpus_pipeline.run(spark, d).count() == sizes[-1]

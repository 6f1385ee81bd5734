import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import markup as M
from tessera.functions import records as R
from tessera.functions import strings as S
from tessera.operators import segment as C


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [tuple(r[1:]) if len(columns) > 1 else r[1] for r in df.select("i", *columns).orderBy("i").collect()]


def test_headers():
    assert [S.sanitize_name(x) for x in ["Game Name", "MIX-%", "a/b", "  Upper  ", "v1.2"]] == ["game_name", "mix_%", "a_b", "upper", "v12"]
    assert S.unique_names(["A B", "a-b", "a/b", "aB"]) == ["a_b", "a_b_1", "a_b_2", "ab"]
    assert len(set(S.unique_names(["a", "a", "a_1"]))) == 3
    assert S.clean_header("  Price ($) / unit. ") == "price_unit"


def test_quotes_and_names(spark):
    texts = ['"Hello"', "'World'", ' "Hello" ', "Hello", "\"'Hello'\""]
    assert values(spark, texts, S.strip_quotes(F.col("x"))) == ["Hello", "World", "Hello", "Hello", "Hello"]
    assert values(spark, ["Poison", "Blind / Silence?", 'Invalid:*?"<>|Name'], S.filename_deleted(F.col("x"))) == ["Poison", "Blind  Silence", "InvalidName"]
    assert values(spark, ["003", "0", " COMMON ", "00"], S.int_or_text(F.col("x"))) == ["3", "0", "COMMON", "0"]
    assert values(spark, ["p12_3", "none"], S.page_number(F.col("x"))) == [12, 999999]


def test_model_answers(spark):
    texts = ['prose {"entries": []} tail', '```json\n{"entries": []}\n```', '<think>{"no": 1}</think>{"entries": []}', '{"entries": []}', "nothing"]
    assert values(spark, texts, S.reasoning_cleaned(F.col("x"))) == ['{"entries": []}'] * 4 + ["nothing"]
    assert values(spark, ["<b>x</b> [[A|B]] [[C]] http://u.v/w  y", None], S.clean_wiki(F.col("x"))) == ["x B C y", ""]
    assert values(spark, ["chat --- x", "none"], S.from_front_matter(F.col("x"))) == ["--- x", "none"]


def test_routes(spark):
    texts = ["https://a/b.pdf", "x.PDF", "a.JPEG", "m/_ocr", "l.lorebook.json", "u.xyz"]
    assert values(spark, texts, S.input_kind(F.col("x"))) == ["web", "pdf", "image", "manga", "json", "unrecognized"]
    assert values(spark, ["Connection reset", "bad value"], S.retryable(F.col("x"))) == [True, False]
    assert values(spark, ["Throttled", "HTTP 500", "502 bad gateway", "temporarily away"], S.retryable(F.col("x"))) == [True, True, False, False]
    assert values(spark, ["about cookies", "x AuthenticationRequiredError", "bad network reputation", "429 Too Many Requests"], S.blocked_page(F.col("x"))) == [False, True, True, True]
    assert values(spark, ["http://h/x/main/y", "http://h/es/"], S.namespace(F.col("x"), ["Main2", "MAIN"])) == ["MAIN", "Main"]


def test_records(spark):
    shapes = ['[{"a":1},2]', '{"entries":{"x":{"a":1},"y":3}}', '{"entries":[{"a":1}]}', '{"1":{"a":1},"0":{"b":2}}', '{"k":{"name":"n"},"z":{"other":1}}', "5", None, "{bad"]
    got = values(spark, shapes, R.entries_of(F.col("x")))
    assert [len(g) for g in got] == [2, 2, 1, 2, 1, 0, 0, 0]
    assert got[3] == ['{"a":1}', '{"b":2}']
    assert values(spark, ['["a"," b ",""]', "a,b ,", "a;b", "7", None, "null"], R.parse_keys(F.col("x"))) == [["a", "b"], ["a", "b"], ["a", "b"], ["7"], [], []]
    e = values(spark, ['{"key":["k"],"keysecondary":["a","k"],"comment":"","uid":"9","priority":"7","order":"x"}'], R.lorebook_entry(F.col("x"), F.lit(1)))[0]
    assert (e["name"], e["keys"], e["priority"], e["insertion_order"], e["content"]) == ("Entry_1", ["a", "k"], 7, 50, "")
    good = '{"Speaker":"A","Dialogue":"hi","Scene Description":"cafe"}'
    assert values(spark, [good, good.replace(" D", "_D"), "{", None], R.valid(F.col("x"), "narrative")) == [True, False, False, False]
    ghosts = values(spark, [None, " \t", "hi"], *R.ghost_rewrite(F.lit("S"), F.col("x")))
    assert ghosts == [("System/Environment", ""), ("System/Environment", ""), ("S", "hi")]


def test_brackets(spark):
    m = values(spark, ["a [Key One: v] b [key one: w] [type:Z]", "none"], M.bracket_map(F.col("x")))
    assert m == [{"key_one": "w", "type": "Z"}, {}]


def chunks_by_rule(text, limit, overlap, delimiter):
    size = lambda xs: sum(map(len, xs)) + len(delimiter) * max(len(xs) - 1, 0)
    out, cur = [], []
    for p in (q.strip()[:limit] for q in text.split(delimiter) if q.strip()):
        if cur and size([*cur, p]) > limit:
            out.append(delimiter.join(cur))
            keep = cur[-overlap:] if overlap else []
            while keep and size([*keep, p]) > limit:
                keep = keep[1:]
            cur = [*keep, p]
        else:
            cur.append(p)
    return out + ([delimiter.join(cur)] if cur else [])


@pytest.mark.parametrize("overlap", [0, 1, 2])
def test_paragraph_chunks(spark, overlap):
    r = random.Random(overlap)
    texts = ["", "x" * 50, "a\n\nb", "y" * 20] + ["\n\n".join("w" * r.randint(0, 25) for _ in range(r.randint(1, 12))) for _ in range(60)]
    got = values(spark, texts, C.paragraph_chunks(F.col("x"), 20, overlap))
    assert got == [chunks_by_rule(t, 20, overlap, "\n\n") for t in texts]
    assert all(len(c) <= 20 for cs in got for c in cs)


def packed_by_rule(items, limit, joiner, extra, at_end):
    out, cur, n = [], [], 0
    for x in items:
        if n + len(x) + (extra if at_end else 0) > limit and (cur or at_end):
            if cur:
                out.append(joiner.join(cur))
            cur, n = [x], len(x)
        else:
            cur, n = [*cur, x], n + len(x) + extra
    return out + ([joiner.join(cur)] if cur else [])


def test_snippets_and_timelines(spark):
    r = random.Random(3)
    texts = ["", "s" * 30, "s" * 31, "One. Two! Three? " * 5] + [" ".join("v" * r.randint(1, 30) + r.choice(".!?,") for _ in range(r.randint(1, 9))) for _ in range(60)]
    none = F.array().cast("array<string>")
    want = [["Definition: " + t] if len(t) <= 30 else ["Definition: " + c for c in packed_by_rule(re.split(r"(?<=[.!?])\s+", t), 30, " ", 1, True)] for t in texts]
    assert values(spark, texts, C.snippet_chunks(F.col("x"), none, 30)) == want
    assert values(spark, ["d"], C.snippet_chunks(F.col("x"), F.array(F.lit("e" * 40), F.lit("f")), 30)) == [["Definition: d", "Examples:\n- " + "e" * 40, "Examples:\n- f"]]
    assert values(spark, texts, C.timeline_chunks(F.split("x", " "), 40)) == [packed_by_rule(t.split(" "), 40, "\n\n", 2, False) for t in texts]


def test_dialogue(spark):
    text = 'lost <|177|003|00|004|>\n"Guide \\I[12]"\nHello, \\C[3]World!\\C[0] How are you?\nThis is a \\C[2]multi-line\nhighlight block\\C[0]!\n<|10|20|30|40|>\n\'Hero\'\nLet\'s go.\n<|actors|002|description|>\nline \\V[101]\n<|e|>\n\n<|10|20|30|40|>\n\'Hero\'\nAgain.'
    df = spark.createDataFrame([("f", text), ("g", "No coordinates here"), ("h", None)], "path string, content string")
    rows = {r.composite_key: r for r in C.dialogue_blocks(df).collect()}
    assert sorted(rows) == ["10-20-30-40", "177-003-00-004", "actors-002-description"]
    a = rows["177-003-00-004"]
    assert (a.file_id, a.map_id, a.event_id, a.line_id, a.name, a.icon_index) == ("177", "3", "0", "4", "Guide", 12)
    assert a.body == "Hello, World! How are you?\nThis is a multi-line\nhighlight block!"
    assert a["keywords"] == ["World!", "multi-line\nhighlight block"]
    assert rows["10-20-30-40"].body == "Again."
    b = rows["actors-002-description"]
    assert (b.file_id, b.map_id, b.line_id, b.name, b.body) == ("actors", "2", "", "", "line \\V[101]")


def test_sections(spark):
    df = spark.createDataFrame([("a", "lost\n# Poison\nP.\n# Blind\nB.\n#NoSpace\n# Poison\nagain"), ("b", "---\ntype: x\n---\n# Silence\nS\n# *?\nlost\n## Stun\nT"), ("c", "---\nopen\n# H\nx"), ("d", "")], "path string, content string")
    got = {(r.path, r.filename): r.content for r in C.markdown_sections(df).collect()}
    assert got == {("a", "Poison.md"): "# Poison\nagain", ("a", "Blind.md"): "# Blind\nB.\n#NoSpace", ("b", "Silence.md"): "---\ntype: x\n---\n# Silence\nS", ("b", "Stun.md"): "---\ntype: x\n---\n## Stun\nT", ("c", "H.md"): "# H\nx"}


def test_entries_of_names_its_file_once(spark):
    assert str(R.entries_of(F.col("whole_file"))).count("whole_file") == 1

"""Boxes near each other by grid, and components over the executors, against all pairs and a plain union-find."""

import random

from tessera.operators import graph as G
from tessera.operators import layout as L

SCHEMA = "image_id long, box_id long, x_min double, x_max double, y_min double, y_max double"


def pages():
    r = random.Random(11)
    rows, n = [], 0
    for image in range(8):
        for _ in range([0, 1, 60, 90, 120, 150, 40, 30][image]):
            w, h = r.choice([5.0, 30.0, 200.0]), r.choice([0.0, 4.0, 8.0, 60.0])
            x, y = r.randint(-50, [500, 100, 2000, 900, 60, 3000, 10, 1][image]) * 1.0, r.randint(-20, [500, 100, 1500, 700, 60, 3000, 0, 1][image]) * 1.0
            if image == 7:
                h = 0.0
            rows.append((image, n, x, x + w, y, y + h))
            n += 1
    rows += [(2, n + i, *rows[30][2:]) for i in range(20)]  # copies of one box
    rows += [(9, n + 100, 0.0, 10.0, 0.0, 10.0), (9, n + 101, 40.0, 50.0, 30.0, 40.0), (9, n + 102, 80.1, 90.0, 0.0, 10.0)]  # gaps just allowed, and not
    return rows + [(9, n + 103, None, 1.0, 1.0, 1.0)]


def plain(rows):
    pairs, parts = set(), {}
    for image in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == image]
        known = [r for r in mine if None not in r]
        h = sum(r[5] - r[4] for r in known) / len(known)
        parts |= {r[1]: r[1] for r in mine}
        for i, a in enumerate(known):
            for b in known[i + 1 :]:
                if max(0, max(a[4], b[4]) - min(a[5], b[5])) <= 2 * h and max(0, max(a[2], b[2]) - min(a[3], b[3])) <= 3 * h:
                    pairs.add((image, min(a[1], b[1]), max(a[1], b[1])))
    changed = True
    while changed:
        changed = False
        for _, a, b in pairs:
            low = min(parts[a], parts[b])
            changed |= parts[a] != low or parts[b] != low
            parts[a] = parts[b] = low
    return pairs, parts


def test_near_boxes_and_components(spark, monkeypatch):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    pairs, parts = plain(rows)
    got = [tuple(r) for r in L.near_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    for limit in (L.PAGE_LINKS, 0):
        monkeypatch.setattr(L, "PAGE_LINKS", limit)
        assert {r.box_id: r.component for r in L.components(df, L.near_pairs(df)).collect()} == parts
    assert L.components(df.limit(0), L.near_pairs(df.limit(0))).count() == 0


def test_a_page_of_very_many_boxes(spark):
    """100,000 words of one page, each near the next in its line: rows in proportion to the boxes."""
    n, line = 100_000, 400
    words = spark.range(n).selectExpr("0L AS image_id", "id AS box_id", f"(id % {line}) * 40.0 AS x_min", f"(id % {line}) * 40.0 + 20 AS x_max", f"floor(id / {line}) * 40.0 AS y_min", f"floor(id / {line}) * 40.0 + 10 AS y_max")
    pairs = L.near_pairs(words)
    assert pairs.count() == n - n // line
    parts = L.components(words, pairs)
    assert parts.filter(f"component <> box_id - box_id % {line}").count() == 0 and parts.count() == n


def test_components_of_chains_and_stars(spark):
    r = random.Random(2)
    names = list(range(1000))
    r.shuffle(names)
    chain = [("c", names[i], names[i + 1]) for i in range(599)]
    star = [("s", 0, i) for i in range(1, 300)]
    pairs = [("c", names[700 + 2 * i], names[701 + 2 * i]) for i in range(50)] + [("s", 5000, 5001), ("s", 5001, 5000), ("s", 7000, 7000)]
    got = {(x.g, x.node): x.component for x in G.components(spark.createDataFrame(chain + star + pairs, "g string, a long, b long")).collect()}
    want = {("c", x): min(names[:600]) for x in names[:600]} | {("s", i): 0 for i in range(300)} | {("s", 5000): 5000, ("s", 5001): 5000}
    for _, a, b in pairs[:50]:
        want |= {("c", a): min(a, b), ("c", b): min(a, b)}
    assert got == want


def test_boxes_meet_in_as_many_tasks_as_they_need(spark, monkeypatch):
    rows = [(k // 20, k, float(k * 37 % 300), float(k * 37 % 300 + 30), float(k * 53 % 200), float(k * 53 % 200 + 9)) for k in range(200)]
    b = spark.createDataFrame(rows, "image_id long, box_id long, x_min double, x_max double, y_min double, y_max double")
    want = {(i, x[1], y[1]) for i in range(10) for x in rows for y in rows if x[0] == y[0] == i and x[1] < y[1] and max(0, max(x[2], y[2]) - min(x[3], y[3])) <= 27 and max(0, max(x[4], y[4]) - min(x[5], y[5])) <= 18}
    monkeypatch.setattr(L, "TASK_BOXES", 30)
    pairs = L.near_pairs(b)
    assert sorted(map(tuple, pairs.collect())) == sorted(want)
    assert pairs.rdd.getNumPartitions() == 7

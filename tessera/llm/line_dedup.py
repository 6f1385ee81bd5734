"""Line deduplication by a segment-partition edit join.

Lines are the \\n-split parts of a text that hold a word. Equal lines are linked, and lines
within tau edits (insert, delete, replace one character) of each other; a class is what
links connect. tau follows the shorter line: 2 from TWO characters on, 1 from ONE on, below
that none, as one edit in a few characters makes another word or number. Of a class the
occurrence in the document with the smallest id, at its smallest position, stays.

tau 2: a line is cut into three disjoint segments, so two edits leave one whole. The head
is anchored at the start, the tail at the end, the middle may move by one place (two edits
before it leave the tail whole). tau 1: into two, anchored at start and end. Segment lengths
follow bands of line length, and a line near a band's lower edge is put into the band
below as well, so that both lines of a pair have the same segments. Lines meet that share
a segment's hash, are close in length and have nearly as many of each letter; they are
then compared by edit distance, a diagonal band of the matrix held in the bits of a number.

A segment that more than FEW lines share makes no pairs. Its lines are compared with the one
of them that occurs most. Where that doesn't bring all of them into one class, they are cut
into four, of which two edits leave two: lines of different classes that share two of
four segments and nearly all pairs of neighbouring characters are compared. Two of four
that more than MOST lines share, as lines of one template do, make no pairs either: such
lines are told apart by what is left of them without what they share (see _cores).

Lines are told apart by 128 bits of hash. Rows with a null id stay whole and count for
nothing; rows with one id are one document. Null and empty texts have no lines. Lines
without a word always stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._cores import meetings
from ._graph import components
from ._shared import WORD, discard, fresh, small, stored
from ._spans import let

TAU, TWO, ONE, BAND, NARROW = 2, 24, 12, 16, 4
#: Lines to a segment up to which all their pairs are taken at once.
FEW = 32
#: The same for two of four segments, and for what follows.
MOST = 128
#: Columns of a sketch.
SKETCH = ["w0", "w1", "w2", "w3"]
#: Columns of a fine key besides.
KIND = ["kind", "x1", "x2", "x3"]


#: Letters that are counted; all other characters are one more group.
LETTERS, BITS = "etnairs", 9


def signature(line: Column) -> Column:
    """How often a line has each letter, in 9 bits: one edit moves one character from a group to another, or in or out."""
    out = F.lit(0).cast("long")
    for i, letter in enumerate(LETTERS):
        n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        out = out.bitwiseOR(F.shiftleft((n % (1 << BITS)).cast("long"), BITS * i))
    return out


def moved(a: Column, b: Column, longer: Column) -> Column:
    """Characters that differ in group between two signatures; longer: by how much a's line is longer. Counts are taken modulo 512, the nearest way round."""
    half, mask = 1 << BITS - 1, F.lit((1 << BITS) - 1).cast("long")
    total, rest = F.lit(0).cast("long"), longer.cast("long")
    for i in range(len(LETTERS)):
        d = (F.shiftright(a, BITS * i) - F.shiftright(b, BITS * i) + half).bitwiseAND(mask) - half
        total, rest = total + F.abs(d), rest - d
    return total + F.abs((rest + half).bitwiseAND(mask) - half)


#: Names of the segment hashes, and whether a segment is one that moved.
KEYS = [f"k{i}" for i in range(14)]
MOVED = [int(i < 10 and i % 5 > 2) for i in range(14)]


def edges(n: Column) -> tuple[Column, Column]:
    """Lower edges of the bands that n characters are in, for tau 2 and tau 1."""
    return n - n % BAND, n - n % NARROW


def bands(n: Column, wide: Column | None = None, thin: Column | None = None) -> list[tuple[str, Column, Column]]:
    """(name, lower edge of a band of lengths, whether a line of n characters is in it): its own and the one below, for tau 2 and tau 1. wide, thin: edges(n), if they are columns already."""
    if wide is None or thin is None:
        wide, thin = edges(n)
    two, one = n >= TWO, (n >= ONE) & (n <= TWO)
    return [("2", wide, two), ("2", wide - BAND, two & (n - TAU < wide) & (wide > BAND)), ("1", thin, one), ("1", thin - NARROW, one & (n - 1 < thin) & (thin > ONE))]


def occurrences(docs: DataFrame, id: str, text: str) -> DataFrame:
    """id, pos, h1, h2 (128 bits of hash), length and segment hashes KEYS of every line with a word."""
    lines = docs.filter(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line")).filter((F.ascii("line") > 32) | F.col("line").rlike(WORD))
    lines = lines.select("id", "pos", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"), F.length("line").alias("length"))
    n = F.col("length")
    # Steps of their own: the code for the keys stays below the size from which the JVM doesn't compile it.
    wide, thin = edges(n)
    lines = lines.select("*", wide.alias("wide"), thin.alias("thin"))
    keys: list[Column] = []
    for name, base, here in bands(n, F.col("wide"), F.col("thin")):
        # What a segment is stands in one number with its band.
        cut = lambda kind, at, long, base=base, here=here: F.when(here, F.xxhash64(base * 8 + kind, F.substring("line", at, long)))
        p = F.call_function("div", base, F.lit(3 if name == "2" else 2)).cast("int")
        first = 0 if name == "2" else 3
        keys += [cut(first, F.lit(1), p), cut(first + 1, n - p + 1, p)]
        if name == "2":
            size = base - 2 * p
            keys += [cut(2, p + at, size) for at in (1, 0, 2)]
    return lines.select("id", "pos", "h1", "h2", "length", *[k.alias(x) for k, x in zip(keys, KEYS, strict=True)])


def band_of(line: Column) -> Column:
    """Array of (name, base) of the bands that a line is in."""
    every = [F.struct(F.lit(name).alias("name"), base.alias("base"), here.alias("here")) for name, base, here in bands(F.length(line))]
    return F.transform(F.filter(F.array(*every), lambda x: x["here"]), lambda x: F.struct(x["name"].alias("name"), x["base"].alias("base")))


#: A line's four segments and where they stand: the middle ones also one place to either side.
PLACES = {"s1": (0, 0), "s2": (1, 0), "s2l": (1, -1), "s2r": (1, 1), "s3": (2, 0), "s3l": (2, -1), "s3r": (2, 1), "s4": (3, 0)}


def _segments(line: Column, band: Column) -> list[Column]:
    """Columns name and base of a band, and PLACES."""
    n, q = F.length(line), F.floor(band["base"] / 4).cast("int")
    start = (F.lit(1), q + 1, n - 2 * q + 1, n - q + 1)
    return [band["name"].alias("name"), band["base"].alias("base"), *[F.substring(line, start[i] + s, q).alias(c) for c, (i, s) in PLACES.items()]]


def _hashed(of: Callable[[str], Column], kind: str, x: str, y: str) -> Column:
    return F.xxhash64(F.lit(kind), of("name"), of("base"), of(x), F.lit("|"), of(y))


def _first_keys(of: Callable[[str], Column]) -> list[Column]:
    """Keys of the kinds 1 to 3, of segments that didn't move."""
    return [_hashed(of, x + y, f"s{x}", f"s{y}").alias(f"x{k}") for k, (x, y) in enumerate(("12", "34", "14"), 1)]


def _all_keys(of: Callable[[str], Column]) -> Column:
    pairs = [(of(f"x{k}"), 0, k) for k in (1, 2, 3)]
    for x, y, xs, ys in (("1", "3", ("",), ("", "l", "r")), ("2", "4", ("", "l", "r"), ("",)), ("2", "3", ("", "l", "r"), ("", "l", "r"))):
        pairs += [(_hashed(of, x + y, f"s{x}{i}", f"s{y}{j}"), int(bool(i or j)), 4) for i in xs for j in ys]
    return F.array_distinct(F.array(*[F.struct(x.alias("key"), F.lit(moved).alias("moved"), F.lit(kind).alias("kind"), *[of(f"x{k}").alias(f"x{k}") for k in (1, 2, 3)]) for x, moved, kind in pairs]))


def fine_keys(line: Column, band: int) -> Column:
    """Array of (key, moved, kind, and the keys of the kinds 1 to 3) in one of the bands: hashes of two of a line's four segments, two from its start and two from its end.

    Where neither the first two nor the last two are whole, each half has one edit, so the others moved by one place at most.
    """
    name, base, _ = bands(F.length(line))[band]
    parts = F.struct(*_segments(line, F.struct(F.lit(name).alias("name"), base.alias("base"))))
    return let(parts, lambda s: let(F.struct(*_first_keys(lambda c: s[c])), lambda x: _all_keys(lambda c: x[c] if c[0] == "x" else s[c])))


def with_fine_keys(t: DataFrame, line: str, *keep: str) -> DataFrame:
    """The columns `keep` and those of fine_keys, for each band and key of a line. Step by step, so that plans and the code made of them stay short."""
    t = t.select(*keep, line, F.explode(band_of(F.col(line))).alias("band"))
    t = t.select(*keep, *_segments(F.col(line), F.col("band")))
    t = t.select(*keep, "name", "base", *PLACES, *_first_keys(F.col))
    tau = F.when(F.col("name") == "2", TAU).otherwise(1).alias("tau")
    return t.select(*keep, tau, F.explode(_all_keys(F.col)).alias("k")).select(*keep, "tau", "k.*")


def _first_kind() -> Column:
    """Whether two lines that meet by a fine key have none of an earlier kind in common; so they meet about once."""
    out = F.lit(True)
    for k in (1, 2, 3):
        out = out & ((F.col("a_kind") <= k) | (F.col(f"a_x{k}") != F.col(f"b_x{k}")))
    return out


def within(a: Column, b: Column, tau: int) -> Column:
    """True if the edit distance of a and b is tau or less; arrays of characters whose lengths differ by tau at most.

    They are columns, not expressions: what stands in a lambda is worked out anew at each step.

    Bit v of a number stands for row j - tau + v of column j of the matrix; VP and VN have
    the bits whose row is one above or below the row before. The distance is followed along
    the diagonal and, at the last column, up or down to the last row.
    """
    p, t = a, b
    width = 2 * tau + 1
    mask = (1 << width) - 1
    m, n = F.size(a), F.size(b)
    lit = lambda x: F.lit(x).cast("long")

    def equal(j: Column) -> Column:
        out = lit(0)
        for v in range(width):
            out = out.bitwiseOR(F.when(F.get(p, j + (v - tau - 1)) == F.get(t, j - 1), lit(1 << v)).otherwise(lit(0)))
        return out

    def step(s: Column, x: Column) -> Column:
        vp, vn = s["vp"], s["vn"]
        d0 = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(lit(mask))
        hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))).bitwiseAND(lit(mask))
        hn = d0.bitwiseAND(vp)
        low = F.shiftright(d0, 1)
        return F.struct(
            hn.bitwiseOR(F.bitwise_not(low.bitwiseOR(hp))).bitwiseAND(lit(mask)).alias("vp"),
            low.bitwiseAND(hp).alias("vn"),
            (s["distance"] + lit(1) - F.shiftright(d0, tau).bitwiseAND(lit(1))).alias("distance"),
        )

    def last(s: Column) -> Column:
        out = s["distance"]
        bit = lambda x, row: F.shiftright(x, row).bitwiseAND(lit(1))
        for k in range(1, tau + 1):  # row n + 1 - tau + v is bit v
            out = out + F.when(m >= n + k, bit(s["vp"], tau - 1 + k) - bit(s["vn"], tau - 1 + k)).otherwise(lit(0))
            out = out - F.when(m <= n - k, bit(s["vp"], tau - k) - bit(s["vn"], tau - k)).otherwise(lit(0))
        return out

    start = F.struct(lit(((1 << (tau + 1)) - 1) << tau).alias("vp"), lit(0).alias("vn"), lit(0).alias("distance"))
    columns = F.transform(F.sequence(F.lit(1), n), equal)
    return F.when(n == 0, m <= tau).otherwise(F.aggregate(columns, start, step, last) <= tau)


def sketch(chars: Column) -> Column:
    """Struct of four numbers, 256 bits: each pair of neighbouring characters turns one of them over, so one edit turns four at most."""
    start = F.struct(*[F.lit(0).cast("long").alias(w) for w in SKETCH])
    grams = let(chars, lambda c: F.transform(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(c, i + 1)).bitwiseAND(F.lit(255).cast("long")).cast("int")))

    def add(s: Column, g: Column) -> Column:
        bit = F.call_function("shiftleft", F.expr("1L"), g % 64)
        return F.struct(*[s[w].bitwiseXOR(F.when(F.floor(g / 64) == j, bit).otherwise(F.expr("0L"))).alias(w) for j, w in enumerate(SKETCH)])

    return F.aggregate(grams, start, add)


def _alike(a: str, b: str) -> Column:
    """Whether no more bits of two sketches differ than tau edits turn over."""
    changed = F.lit(0)
    for w in SKETCH:
        changed = changed + F.bit_count(F.col(f"{a}_{w}").bitwiseXOR(F.col(f"{b}_{w}")))
    return changed <= 4 * F.when(F.least(F.col(f"{a}_length"), F.col(f"{b}_length")) >= TWO, TAU).otherwise(1)


def _close(a: str, b: str) -> Column:
    """Whether two lines may be within tau edits, by length and letters."""
    of = lambda s, c: F.col(f"{s}_{c}")
    tau = F.when(F.least(of(a, "length"), of(b, "length")) >= TWO, TAU).otherwise(1)
    letters = moved(of(a, "signature"), of(b, "signature"), of(a, "length") - of(b, "length"))
    return (F.abs(of(a, "length") - of(b, "length")) <= tau) & (letters <= 2 * tau)


def _side(t: DataFrame, s: str, *more: str) -> DataFrame:
    return t.select("key", *[F.col(c).alias(f"{s}_{c}") for c in ("line", "length", "signature", "moved", *more)])


def _pair() -> list[Column]:
    return [F.least("a_line", "b_line").alias("a"), F.greatest("a_line", "b_line").alias("b")]


def _with_first(t: DataFrame) -> DataFrame:
    """Pairs (a, b): each line of a key and the one that occurs most."""
    first = t.groupBy("key").agg(F.max(F.struct("n", "line", "length", "signature", "moved")).alias("x")).select("key", "x.*")
    return _side(t, "a").join(_side(first, "b"), "key").filter((F.col("a_line") != F.col("b_line")) & _close("a", "b")).select(*_pair())


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b) those within tau edits, as a stored table; texts: line, chars, sketch."""
    side = lambda i, x: texts.select(F.col("line").alias(i), F.col("chars").alias(x), F.size("chars").alias(f"{x}_length"), *[F.col(f"sketch.{w}").alias(f"{x}_{w}") for w in SKETCH])
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").filter(_alike("x", "y"))
    near = F.when(F.least(F.size("x"), F.size("y")) >= TWO, within(F.col("x"), F.col("y"), TAU)).otherwise(within(F.col("x"), F.col("y"), 1))
    return stored(both.filter(near).select("a", "b"), "line-links")


def _with_classes(t: DataFrame, classes: DataFrame, rows: int) -> DataFrame:
    """t with the class (node, component) of a line, the line itself if none; only of keys that have several classes."""
    t = t.join(small(classes.withColumnRenamed("node", "line"), rows), "line", "left").withColumn("class", F.coalesce("component", "line")).drop("component")
    t = stored(t, "line-classed")  # its keys are made once, not for the groups and again for the join
    several = t.groupBy("key").agg(F.min("class").alias("p"), F.max("class").alias("q")).filter("p < q").select("key")
    out = stored(t.join(several, "key"), "line-open")
    discard(t)
    return out


def near_lines(docs: DataFrame, lines: DataFrame, text: str) -> DataFrame:
    """a, b: links between near lines, enough to connect each class. lines: a row for each distinct line: line (a number), h1, h2, n (occurrences), length, KEYS. Letters are counted in lines that share a segment."""
    kinds = F.array(*[F.when(F.col(k).isNotNull(), F.struct(F.col(k).alias("key"), F.lit(m).alias("moved"))) for k, m in zip(KEYS, MOVED, strict=True)])
    every = lines.filter(F.col("length") >= ONE).select("line", "h1", "h2", "n", "length", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("k")).select("line", "h1", "h2", "n", "length", "k.*")
    shared = stored(every.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "line-keys")
    met = stored(every.join(small(shared, shared.count()), "key"), "line-met")
    discard(shared)
    wanted = stored(met.select("line", "h1", "h2").distinct(), "line-wanted")
    rows = wanted.count()
    found = docs.select(F.explode(F.split(F.col(text), "\n")).alias("t")).filter(F.length("t") >= ONE).withColumn("h1", F.xxhash64("t"))
    found = found.join(small(wanted.select("h1").distinct(), rows), "h1", "left_semi").groupBy("h1", F.xxhash64(F.lit("second"), "t").alias("h2")).agg(F.max("t").alias("t"))
    found = stored(found.join(small(wanted, rows), ["h1", "h2"]).select("line", "t", signature(F.col("t")).alias("signature")), "line-found")
    discard(wanted)
    held = stored(met.join(small(found.select("line", "signature"), rows), "line").drop("h1", "h2"), "line-held")
    discard(met)
    usual, hot = held.filter(F.col("m") <= FEW), held.filter(F.col("m") > FEW)
    meet = _side(usual, "a").join(_side(usual, "b"), "key").filter((F.col("a_line") < F.col("b_line")) & (F.col("a_moved") + F.col("b_moved") < 2) & _close("a", "b")).select(*_pair())
    pairs = stored(meet.unionByName(_with_first(hot)).distinct(), "line-pairs")

    compared = pairs.select(F.explode(F.array("a", "b")).alias("line")).unionByName(hot.select("line")).distinct()
    texts = stored(found.join(compared, "line", "left_semi").select("line", "t", F.split("t", "").alias("chars")).withColumn("sketch", sketch(F.col("chars"))), "line-texts")
    discard(found)

    links = _verified(pairs, texts)
    discard(pairs)
    if not hot.isEmpty():
        links = _among(hot, texts, links)
    discard(held)
    discard(texts)
    return links


def _among(hot: DataFrame, texts: DataFrame, links: DataFrame) -> DataFrame:
    """links, and what they lack among lines that share a frequent segment."""
    classes = components(links)
    rows = classes.count()
    opened = _with_classes(hot.select("line", "key"), classes, rows)
    rest = hot.select("line", "n", "length", "signature").distinct().join(opened.select("line").distinct(), "line", "left_semi")
    cut = rest.join(texts.select("line", "t", "sketch.*"), "line")
    fine = with_fine_keys(cut, "t", "line", "length", "signature", *SKETCH)
    mine = _with_classes(fine, classes, rows)
    often = stored(mine.groupBy("key").agg(F.count("*").alias("m")).filter(F.col("m") > MOST).select("key"), "line-often")
    frequent = often.count()
    across = (F.col("a_line") < F.col("b_line")) & (F.col("a_class") != F.col("b_class")) & _close("a", "b") & _alike("a", "b")
    by_fine = across & (F.col("a_moved") + F.col("b_moved") < 2) & _first_kind()
    usual = mine.join(small(often, frequent), "key", "left_anti") if frequent else mine
    pairs = [stored(_side(usual, "a", "class", *SKETCH, *KIND).join(_side(usual, "b", "class", *SKETCH, *KIND), "key").filter(by_fine).select(*_pair()).distinct(), "line-pairs")]
    if frequent:
        told = ["key", "tau", "line", "class", "length", "signature", *SKETCH]
        rows = mine.join(small(often, frequent), "key").select(*told).dropDuplicates(["key", "line"])
        rows = stored(rows.join(texts.select("line", F.col("t").alias("r")), "line"), "line-cores")
        side = lambda t, s: t.select("key", *[F.col(c).alias(f"{s}_{c}") for c in told[2:]])
        pairs += meetings(rows, MOST, lambda t: side(t, "a").join(side(t, "b"), "key").filter(across).select(*_pair()))
    every = pairs[0]
    for x in pairs[1:]:
        every = every.unionByName(x)
    out = links.unionByName(_verified(every.distinct(), texts))
    for x in (opened, mine, often, classes, *pairs):
        discard(x)
    return out


def verdicts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_lines, n_near (lines in a class with a different line), n_kept, dropped (positions) of every id that has a line with a word."""
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    at = stored(occurrences(docs, "id", "text"), "line-occurrences")
    facts = [F.min("id").alias("first_id"), F.count("*").alias("n"), F.max("length").alias("length"), *[F.max(k).alias(k) for k in KEYS]]
    lines = stored(at.groupBy("h1", "h2").agg(*facts).withColumn("line", F.monotonically_increasing_id()), "lines")
    links = near_lines(docs, lines, "text")
    parts = components(links)
    # Only lines that are repeated or near others matter; all others stay.
    known = lines.select("h1", "h2", "line", "first_id", "n").join(small(parts.withColumnRenamed("node", "line"), parts.count()), "line", "left").filter("n > 1 or component is not null")
    known = known.select("h1", "h2", "first_id", F.coalesce("component", "line").alias("class"), F.col("component").isNotNull().alias("near"))
    known = stored(known, "line-classes")
    discard(lines)
    first = known.groupBy("class").agg(F.min("first_id").alias("class_first"))
    marked = stored(known.join(small(first, known.count()), "class").select("h1", "h2", "class", "near", "class_first"), "line-marked")
    discard(known)
    here = at.select("id", "pos", "h1", "h2").join(small(marked, marked.count()), ["h1", "h2"])
    by_class = here.groupBy("id", "class").agg(F.min("pos").alias("p"), F.sum(F.col("near").cast("long")).alias("n_near"), F.first("class_first").alias("first_id"), F.collect_list("pos").alias("all"))
    gone = F.when(F.col("id") == F.col("first_id"), F.filter("all", lambda x: x != F.col("p"))).otherwise(F.col("all"))
    # Of rows with one id a place may be named twice; it is one line then.
    by_id = by_class.select("id", "n_near", gone.alias("gone")).groupBy("id").agg(F.sum("n_near").alias("n_near"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("dropped"), F.sum(F.size("gone")).alias("n_gone"))
    out = at.groupBy("id").agg(F.count("*").alias("n_lines")).join(by_id, "id", "left")
    zero = F.lit(0).cast("long")
    out = out.select(F.col("id").alias(id), "n_lines", F.coalesce("n_near", zero).alias("n_near"), (F.col("n_lines") - F.coalesce("n_gone", zero)).alias("n_kept"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    out = stored(out, "line-verdicts")
    for x in (at, marked, parts):
        discard(x)
    return out


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their dropped lines taken out; a document all of whose lines with words go, goes."""
    own, dropped, gone = (fresh(docs, c) for c in ("_id", "_dropped", "_gone"))
    v = verdicts(docs, id, text).filter(F.size("dropped") > 0).select(F.col(id).alias(own), F.col("dropped").alias(dropped), (F.col("n_kept") == 0).alias(gone))
    # Texts meet their lines' verdicts in one shuffle, whatever the size: no size changes the plan, and the driver gathers nothing.
    out = docs.join(v.hint("merge"), F.col(id) == F.col(own), "left").filter(~F.coalesce(gone, F.lit(False)))
    left = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(dropped, i))
    kept = F.when(F.col(dropped).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return out.withColumn(text, kept).select(*docs.columns)


def report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: id, n_lines, n_near, n_kept, dropped_sha256 (of the dropped positions, comma-joined)."""
    v = verdicts(docs, id, text)
    v = v.select(F.col(id).alias("_id"), "n_lines", "n_near", "n_kept", F.sha2(F.array_join(F.col("dropped").cast("array<string>"), ","), 256).alias("dropped_sha256"))
    zero = F.lit(0).cast("long")
    rows = docs.select(F.col(id).alias(id)).join(v, F.col(id) == F.col("_id"), "left")
    return rows.select(id, *[F.coalesce(c, zero).alias(c) for c in ("n_lines", "n_near", "n_kept")], F.coalesce("dropped_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("dropped_sha256"))

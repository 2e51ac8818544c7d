"""Repeated lines: exact copies, and lines within two edits, by a segment-partition join in SQL.

A line of the smaller or equal length is cut into ``EDITS + 1`` segments. Whatever two edits do to it, one segment
stays whole, and the number of edits before and after it bounds where it can stand in the other line. So each
line is entered under the hashes of its segments (with length and segment number), and looked up under
those of the few substrings that could be a segment of a line as long or up to two shorter. Keys that many lines
have (those made from one template) are divided: the rest of the line is cut into segments once more. Pairs that meet, and
whose counts of some letters differ by no more than the edits allow, are verified: without their common beginning and end, by a banded bit-parallel automaton that holds, for each
number of edits, the diagonals reached as bits of one number.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmap.llm.common import bounded, fresh, parked

EDITS = 2
#: Code points from which a line is compared with others by edits; shorter ones repeat as exact copies only.
LEAST_LENGTH = 20
#: Letters that are counted; any would do, frequent ones tell most.
COUNTED = "etnaisrohdlucmwb"
BROADCAST_ROWS = 1_000_000
#: A key under which more lines are entered is divided.
HOT = 50
#: Where a line is looked up: code points that the other one has less, number of its segment, code points that
#: the segment stands further on here. At most as many edits as the number are before a segment, the others are after it.
#: Of two lines as long, the one whose middle stands further on finds the other.
FORMS = [(0, 0, 0), (0, 1, 0), (0, 2, 0), (0, 1, 1), (1, 0, 0), (1, 1, 0), (1, 1, 1), (1, 2, 1), (2, 0, 0), (2, 1, 1), (2, 2, 2)]
#: The first ones are a line's own segments.
ENTERED = EDITS + 1
# Fixed value: characters that do not count at a line's ends.
BLANKS = "".join(map(chr, range(33)))


def _measured(lines: DataFrame) -> DataFrame:
    """Start (from 1) and length of each segment of a line as long, one shorter and two shorter.

    Later segments take the remainder. The columns are a step of their own: written out in each key, the
    generated code would be too long to compile.
    """
    parts, columns = EDITS + 1, {}
    for shorter in range(EDITS + 1):
        length = F.col("length") - shorter
        columns[f"size{shorter}"] = (length / parts).cast("int")
        columns[f"rest{shorter}"] = (length % parts).cast("int")
    lines = lines.withColumns(columns)
    columns = {}
    for shorter in range(EDITS + 1):
        size, longer = F.col(f"size{shorter}"), F.col(f"rest{shorter}")
        for number in range(parts):
            extra = F.greatest(F.lit(number - parts) + longer, F.lit(0))
            columns[f"start{shorter}{number}"] = size * number + extra + 1
            columns[f"size{shorter}{number}"] = size + (longer >= parts - number).cast("int")
    return lines.withColumns(columns)


def _keyed(classes: DataFrame) -> DataFrame:
    """``node, form, key``: a row for each of ``FORMS``; under the first ones a line is entered, under all it is looked up."""
    keys = []
    for shorter, number, shift in FORMS:
        start, size = F.col(f"start{shorter}{number}"), F.col(f"size{shorter}{number}")
        keys.append(F.xxhash64(F.col("length") - shorter, F.lit(number), F.col("line").substr(start + shift, size)))
    return _measured(classes).select("node", F.posexplode(F.array(*keys)).alias("form", "key"))


def _letters() -> Column:
    """How often a line has each of the counted letters, modulo 16, as digits of one number."""
    line = F.col("line")
    counts = [F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit(""))) for c in COUNTED]
    return sum((F.shiftleft((n % 16).cast("long"), 4 * i) for i, n in enumerate(counts)), F.lit(0).cast("long"))


def _alike(a: str, b: str) -> Column:
    """Whether the counts differ by two for each edit at most: one letter less, another more."""
    digits = [(f"(shiftright({a}, {4 * i}) & 15L)", f"(shiftright({b}, {4 * i}) & 15L)") for i in range(len(COUNTED))]
    steps = [f"abs((({x} - {y} + 8) & 15L) - 8)" for x, y in digits]
    return F.expr(f"{' + '.join(steps)} <= {2 * EDITS}")


def _met(keyed: DataFrame, entered: Column) -> DataFrame:
    """Rows whose key another row has, if any is entered there, with ``size``: how many are.

    Counts fold before they are shuffled, so that a key that a third of all rows have stays in no task.
    """
    counts = keyed.groupBy("key").agg(F.count_if(entered).alias("size"), F.count("*").alias("rows"))
    counts = parked(counts.filter("size > 0 AND rows > 1").select("key", "size"))
    return parked(keyed.join(bounded(counts, BROADCAST_ROWS), "key"))


def _first_states(rows: DataFrame) -> DataFrame:
    """What the key of a line's segment leaves open: all before, all after it, or one part on either side."""
    def by_form(values) -> Column:
        return F.element_at(F.array(*(F.lit(v) for v in values)), F.col("form") + 1)

    rows = rows.withColumns({name: by_form([form[i] for form in FORMS]) for i, name in enumerate(("shorter", "number", "shift"))})
    rows = rows.withColumns({"n": F.col("length") - F.col("shorter"), "entered": F.col("form") < ENTERED})
    # As in _measured: the remainder goes to the last segments.
    rows = rows.withColumns({"z0": F.expr("n div 3"), "z1": F.expr("(n + 1) div 3"), "z2": F.expr("(n + 2) div 3")})
    return rows.selectExpr(
        "key", "node", "size", "entered", "shorter", "shift", "if(number = 0, z0, 0) AS p0",
        "CASE number WHEN 0 THEN z1 + z2 WHEN 1 THEN z0 ELSE z0 + z1 END AS pn",
        "if(number = 1, z0 + z1, NULL) AS q0", "if(number = 1, z2, NULL) AS qn",
    )


def _divided(states: DataFrame) -> DataFrame:
    """The keys, one step finer, of rows with ``line``.

    One open part holds up to two edits: of its three segments one is whole, and the rest stays open, as
    one part or, if the middle is whole, as two. Two open parts hold one edit each: of either, one half is whole. Before
    the first open part the line stands as in the shorter one, after the last it is ``shorter`` further on, and
    between two it is ``shift`` further on.
    """
    def child(key: str, entered: str, shift: str, p0: str, pn: str, q0: str = "CAST(NULL AS INT)", qn: str = "CAST(NULL AS INT)") -> str:
        return (
            f"named_struct('key', xxhash64(key, {key}), 'entered', {entered}, 'shorter', shorter, 'shift', {shift},"
            f" 'p0', {p0}, 'pn', {pn}, 'q0', {q0}, 'qn', {qn})"
        )

    def middle(entered: str, shift: int) -> str:
        return child(f"1, substring(line, p0 + z0 + {shift + 1}, z1)", entered, str(shift), "p0", "z0", "p0 + z0 + z1", "z2")

    one = [
        child("0, substring(line, p0 + 1, z0)", "entered", "0", "p0 + z0", "z1 + z2"),
        child("2, substring(line, p0 + z0 + z1 + shorter + 1, z2)", "entered", "0", "p0", "z0 + z1"),
        f"if(shorter < 2, {middle('entered', 0)}, NULL)",
        middle("false", 1),
    ]
    two = []
    for x, whole_p, open_p in ((0, "p0 + u0 + shift + 1, u1", ("p0", "u0")), (1, "p0 + 1, u0", ("p0 + u0", "u1"))):
        for y, whole_q, open_q in ((0, "q0 + v0 + shorter + 1, v1", ("q0", "v0")), (1, "q0 + shift + 1, v0", ("q0 + v0", "v1"))):
            key = f"{3 + 2 * x + y}, substring(line, {whole_p}), substring(line, {whole_q})"
            two.append(child(key, "entered", "shift", *open_p, *open_q))
    sizes = {"z0": "pn div 3", "z1": "(pn + 1) div 3", "z2": "(pn + 2) div 3", "u0": "pn div 2", "v0": "qn div 2"}
    states = states.withColumns({name: F.expr(f"CAST({size} AS INT)") for name, size in sizes.items()})
    states = states.withColumns({"u1": F.expr("pn - u0"), "v1": F.expr("qn - v0")})
    found = F.expr(f"filter(if(q0 IS NULL, array({', '.join(one)}), array({', '.join(two)})), c -> c IS NOT NULL)")
    return states.select("node", F.inline(found))


def candidate_pairs(classes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of lines that share a key, with like counts of letters; among them all within ``EDITS``.

    A key under which more than ``HOT`` lines are entered is divided, until the lines are too few or what it leaves open
    is too short; lines that then meet differ in a few neighbouring places alone.
    """
    classes = classes.filter(F.col("length") >= LEAST_LENGTH)
    rows = _met(_keyed(classes), F.col("form") < ENTERED)
    nodes = bounded(rows.select("node").distinct(), BROADCAST_ROWS)
    texts = parked(classes.select("node", "line", "length").join(nodes, "node", "left_semi").withColumn("letters", _letters()))
    cool = rows.filter(F.col("size") <= HOT).withColumn("entered", F.col("form") < ENTERED)
    found = [_meeting(cool, texts)]
    states = _first_states(rows.filter(F.col("size") > HOT).join(texts.select("node", "length"), "node"))
    final = F.when(F.col("q0").isNull(), F.col("pn") <= EDITS).otherwise((F.col("pn") <= 1) & (F.col("qn") <= 1))
    hot = parked(states)
    lines = texts.select("node", "line")
    while hot.limit(1).count():
        finer = _met(parked(_divided(hot.join(lines, "node"))), F.col("entered"))
        done = (F.col("size") <= HOT) | final
        found.append(_meeting(finer.filter(done), texts))
        hot = parked(finer.filter(~done))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return parked(pairs.distinct())


def _meeting(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of an entered row and another one with its key; a line that is entered is looked up there, too."""
    rows = parked(rows.select("key", "node", "entered").join(texts.select("node", "letters"), "node"))
    entered = rows.filter("entered").select("key", F.col("node").alias("a"), F.col("letters").alias("ca"))
    looked = rows.select("key", F.col("node").alias("b"), F.col("letters").alias("cb"), F.col("entered").alias("both"))
    pairs = entered.join(looked, "key").filter("a < b OR (a > b AND NOT both)").filter(_alike("ca", "cb"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def edit_links(classes: DataFrame) -> DataFrame:
    """All pairs ``a, b`` of distinct lines with at most ``EDITS`` edits, from ``node long, line string, length int``."""
    pairs = candidate_pairs(classes)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = parked(classes.select("node", "line").join(bounded(ends, BROADCAST_ROWS), "node", "left_semi"))
    first = texts.withColumnsRenamed({"node": "a", "line": "la"}).join(bounded(pairs, BROADCAST_ROWS), "a")
    both = first.join(texts.withColumnsRenamed({"node": "b", "line": "lb"}), "b")
    return both.filter(within_edits("la", "lb")).select("a", "b")


def _common_prefix(a: str, b: str) -> str:
    """SQL for the number of code points that two texts have in common at their beginning."""
    steps = ", ".join(str(1 << k) for k in range(30, -1, -1))
    return (
        f"aggregate(array({steps}), 0, (n, s) -> if(n + s <= least(length({a}), length({b}))"
        f" AND substring({a}, n + 1, s) = substring({b}, n + 1, s), n + s, n))"
    )


def within_edits(a: str, b: str) -> Column:
    """Whether two text columns are at most ``EDITS`` edits apart.

    Bit d of the state for e edits says that the automaton has, with e edits, read d - EDITS code points more of
    ``a`` than of ``b``. A code point of ``b`` moves all diagonals at once.
    """
    width = 2 * EDITS + 1
    full = (1 << width) - 1
    same = " | ".join(
        f"if(j + {d - EDITS} BETWEEN 1 AND size(p.x) AND p.x[j + {d - EDITS - 1}] = p.y[j - 1], {1 << d}, 0)" for d in range(width)
    )
    # By number of edits: match, else substitution (same diagonal) or insertion (one less), then deletions.
    step, previous = [], None
    for e in range(EDITS + 1):
        bits = f"(r.s{e} & r.same)"
        if e:
            bits = f"({bits} | r.s{e - 1} | shiftright(r.s{e - 1}, 1) | (shiftleft({previous}, 1) & {full}))"
        step.append(bits)
        previous = bits
    start = [sum(1 << (EDITS + d) for d in range(e + 1)) for e in range(EDITS + 1)]
    opening = ", ".join(f"'s{e}', {bits}" for e, bits in enumerate(start))
    moved = ", ".join(f"'s{e}', {bits}" for e, bits in enumerate(step))
    carried = ", ".join(f"'s{e}', r.s{e}" for e in range(EDITS + 1))
    run = (
        f"aggregate(sequence(1, size(p.y)), named_struct({opening}), (q, j) -> "
        f"transform(array(named_struct('same', {same}, {carried.replace('r.', 'q.')})), r -> named_struct({moved}))[0])"
    )
    run = f"if(size(p.y) = 0, named_struct({opening}), {run})"
    end = f"least(greatest(size(p.x) - size(p.y) + {EDITS}, 0), {width})"
    reached = f"(({run}).s{EDITS} & shiftleft(1, {end})) <> 0"
    middle = (
        f"transform(array(named_struct('n', {_common_prefix(a, b)})), v -> "
        f"named_struct('x', substring({a}, v.n + 1), 'y', substring({b}, v.n + 1)))[0]"
    )
    tail = _common_prefix("reverse(v.x)", "reverse(v.y)")
    letters = "filter(split({0}, ''), c -> c <> '')"
    inner = (
        f"transform(array({middle}), v -> transform(array({tail}), n -> named_struct("
        f"'x', {letters.format('substring(v.x, 1, length(v.x) - n)')}, 'y', {letters.format('substring(v.y, 1, length(v.y) - n)')}))[0])[0]"
    )
    # A transform of one element gives a name to what several parts of an expression need.
    return F.expr(f"abs(length({a}) - length({b})) <= {EDITS} AND transform(array({inner}), p -> {reached})[0]")


def line_rows(docs: DataFrame, shortest: int = LEAST_LENGTH) -> DataFrame:
    """A row for each line of ``shortest`` code points, with its place and the hashes of what is compared."""
    lines = docs.select("doc_id", "text").select(
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"),
    )
    lines = lines.withColumn("line", F.btrim("line", F.lit(BLANKS)))
    return lines.filter(F.length("line") >= shortest).withColumns(
        {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")}
    )


def line_classes(docs: DataFrame, shortest: int = LEAST_LENGTH) -> DataFrame:
    """``node, h1, h2, line, length, copies, first``: distinct lines and the place where each is first."""
    lines = line_rows(docs, shortest)
    place = F.struct("doc", "text_hash", "line_no")
    classes = lines.groupBy("h1", "h2").agg(F.first("line").alias("line"), F.count("*").alias("copies"), F.min(place).alias("first"))
    classes = classes.withColumn("length", F.length("line"))
    return parked(classes.withColumn("node", F.monotonically_increasing_id()))


def judged_classes(docs: DataFrame, shortest: int = LEAST_LENGTH) -> DataFrame:
    """``h1, h2, first, links, near``: each class of lines that is repeated or linked, and whether an earlier line is near."""
    classes = line_classes(docs, shortest)
    links = parked(edit_links(classes.select("node", "line", "length")))
    both = links.unionByName(links.selectExpr("b AS a", "a AS b"))
    linked = bounded(both.select(F.col("a").alias("node")).distinct(), BROADCAST_ROWS)
    places = parked(classes.select("node", "h1", "h2", "copies", "first").join(linked, "node", "left_semi"))
    earliest = both.join(places.select(F.col("node").alias("b"), F.col("first").alias("other")), "b")
    earliest = earliest.groupBy(F.col("a").alias("node")).agg(F.min("other").alias("earliest"), F.count("*").alias("links"))
    near = places.join(earliest, "node").select("h1", "h2", "first", "links", (F.col("earliest") < F.col("first")).alias("near"))
    repeated = classes.filter("copies > 1").join(linked, "node", "left_anti")
    return near.unionByName(repeated.select("h1", "h2", "first", F.lit(0).cast("long").alias("links"), F.lit(False).alias("near")))


def judged_lines(docs: DataFrame, shortest: int = LEAST_LENGTH) -> DataFrame:
    """The lines that are repeated or linked: ``doc, text_hash, line_no, links, near, exact``.

    ``near``: an earlier line of another text is within ``EDITS``. ``exact``: it is a copy of an earlier line.
    """
    judged = parked(judged_classes(docs, shortest))
    lines = line_rows(docs, shortest).drop("line").join(judged, ["h1", "h2"])
    place = F.struct("doc", "text_hash", "line_no")
    return lines.select("doc", "text_hash", "line_no", "links", "near", (place > F.col("first")).alias("exact"))


def line_report(docs: DataFrame, shortest: int = LEAST_LENGTH) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_exact, n_near, n_links, n_removed``.

    Lines of ``shortest`` code points, without white space around, take part; 1 takes every line that is not
    blank. One is removed if a line before it, in order of ``doc_id`` and line, is equal (``n_exact``) or, where both
    have ``LEAST_LENGTH`` code points, at most ``EDITS`` edits away (``n_near``).
    ``n_links`` counts, for each of its lines, the distinct texts within the edits. NULL and empty texts have no
    lines; NULL ids come last in the order; rows equal in id and text are treated alike.
    """
    docs = docs.select("doc_id", "text")
    doc, text_hash = F.coalesce("doc_id", F.lit((1 << 63) - 1)), F.xxhash64("text")
    plain = docs.select("doc_id", doc.alias("doc"), text_hash.alias("text_hash"), F.when(F.length("text") > 0, F.size(F.split("text", "\n", -1))).otherwise(0).cast("long").alias("n_lines"))
    removed = F.col("exact") | F.col("near")
    counts = judged_lines(docs, shortest).distinct().groupBy("doc", "text_hash").agg(
        F.count_if("exact").alias("n_exact"), F.count_if("near").alias("n_near"),
        F.sum("links").alias("n_links"), F.count_if(removed).alias("n_removed"),
    )
    found = plain.join(counts, ["doc", "text_hash"], "left").drop("doc", "text_hash")
    return found.fillna(0, ["n_exact", "n_near", "n_links", "n_removed"])


def without_repeated_lines(docs: DataFrame, shortest: int = LEAST_LENGTH) -> DataFrame:
    """``docs`` without the lines that ``line_report`` counts as removed; all rows and columns stay.

    A text that loses all its lines is empty; one that loses none is left as it is, to the byte.
    """
    doc, text_hash, gone = (fresh(docs, name) for name in ("_doc", "_text_hash", "_dropped"))
    dropped = judged_lines(docs, shortest).filter("exact OR near").groupBy("doc", "text_hash").agg(F.collect_set("line_no").alias(gone))
    dropped = bounded(parked(dropped.withColumnsRenamed({"doc": doc, "text_hash": text_hash})), BROADCAST_ROWS // 5)
    keyed = docs.withColumns({doc: F.coalesce("doc_id", F.lit((1 << 63) - 1)), text_hash: F.xxhash64("text")})
    kept = f"array_join(filter(split(text, '\\n', -1), (x, i) -> NOT array_contains({gone}, i)), '\\n')"
    found = keyed.join(dropped, [doc, text_hash], "left")
    found = found.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.expr(kept)))
    return found.select(*docs.columns)

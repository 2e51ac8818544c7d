"""Near duplicates by MinHash, with odd sketches for the candidates and exact sets for the links.

Documents with the same set of shingles are one class. A class has a MinHash signature; its bands put it
into buckets. Folded into a bitmap by parity, the signature's samples are an odd sketch: where two sets
share a sample, its bit cancels, so the number of ones in the XOR of two sketches estimates the sets'
difference, most precisely where they are alike. Candidates that the sketches leave are compared as full sets.

No group is expanded into all its pairs. Each bucket has a centre; first every class is compared with the
most similar centre of its buckets, then with centres in other components. Where a bucket still holds several
components, its members are written as differences from a hub in the largest one, and pairs in different components
are found by an exact prefix filter on these differences (see ``_differences``). So no pair of a bucket is left
that is similar enough and not in one component. Two sets of similarity 0.8 have no bucket together
with a probability of 5e-8, with 32 bands of 4 rows.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readmap.llm.common import bounded, fresh, map_texts, parked
from readmap.llm.components import components
from readmap.llm.shingles import mixed, shingle_set, word_hashes
from readmap.llm.tokens import each_utf8, utf8

BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: How far an estimate may lie below the asked similarity: five standard errors of 128 samples.
MARGIN = 0.2
#: Rows of a table of ids that is broadcast; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 1_000_000

SKETCHED = "doc_id long, text_hash long, n_shingles long, key binary, sketch array<long>, bands array<long>"


def _constants(seed: int) -> np.ndarray:
    return mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each of ``SAMPLES`` hash functions over a non-empty set."""
    masks, factors = _constants(1), _constants(2) | np.uint64(1)
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 256):
        part = shingles[start : start + 256, None]
        np.minimum(least, ((part ^ masks) * factors).min(axis=0), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as 64-bit words."""
    places = (mixed(samples ^ _constants(3)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = (np.bincount(places, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def band_keys(samples: np.ndarray) -> np.ndarray:
    out = np.arange(BANDS, dtype=np.uint64)
    for row in range(ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + samples[row::ROWS])
    return out.view(np.int64)


def most_bits(similarity: float) -> int:
    """Ones to expect in the XOR of the sketches of two sets of this similarity."""
    return math.floor(SKETCH_BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - similarity) / SKETCH_BITS)))


def sketches(docs: DataFrame, shingle_words: int) -> DataFrame:
    """Set size, set key, sketch and bands of each whole text; an empty set has neither sketch nor bands."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        longs = pa.list_(pa.int64())
        kinds = [pa.int64(), pa.binary(), longs, longs]
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for text in each_utf8(batch.column(1)):
                shingles = shingle_set(word_hashes(text), shingle_words)
                row = (0, b"", None, None)
                if len(shingles):
                    samples = signature(shingles)
                    row = (len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()), odd_sketch(samples), band_keys(samples))
                for column, value in zip(columns, row):
                    column.append(value)
            arrays = [batch.column(0).cast(pa.int64()), batch.column(2), *(pa.array(c, t) for c, t in zip(columns, kinds))]
            yield pa.record_batch(arrays, ["doc_id", "text_hash", "n_shingles", "key", "sketch", "bands"])

    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return map_texts(texts, sketch, SKETCHED)


def shingle_sets(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``key binary, shingles array<long>``: the full set of each whole text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                found = [shingle_set(word_hashes(text), shingle_words) for text in utf8(batch.column(0).slice(start, 500))]
                keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"" for s in found], pa.binary())
                part = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
                yield pa.record_batch([keys, part], ["key", "shingles"])

    return map_texts(docs.select("text"), sets, "key binary, shingles array<long>")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets (``shingle_words``
    consecutive words, A-Z in lower case, words between ASCII white space). ``component_id`` is the smallest
    ``doc_id`` reachable over links, ``kept`` says whether that is the document's own.

    NULL and empty texts have an empty set and no links; a text with fewer words than a shingle has its whole
    sequence as one. Rows with a NULL id are not linked: their component is NULL and they are kept. Rows
    that repeat an id are documents of their own. ``percent`` is 50 to 100: the bands are made for high similarity.
    Only ``doc_id`` and ``text`` are read.
    """
    return _judged(docs, shingle_words, percent).drop("text_hash")


def without_near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that ``near_duplicates`` does not keep; of rows equal in id and text, one stays.

    All columns stay. Rows with a NULL id stay, as do empty texts, unless such a row is repeated.
    """
    judged = parked(_judged(docs, shingle_words, percent))
    keys = [fresh(docs, "_doc_id"), fresh(docs, "_text_hash")]
    places = judged.withColumnsRenamed(dict(zip(("doc_id", "text_hash"), keys)))
    same = F.col(keys[0]).eqNullSafe(F.col("doc_id")) & (F.col(keys[1]) == F.xxhash64("text"))
    removed = bounded(places.filter("NOT kept").select(*keys), BROADCAST_ROWS)
    repeated = bounded(parked(places.filter("kept").groupBy(*keys).count().filter("count > 1").select(*keys)), BROADCAST_ROWS)
    stay = docs.join(removed, same, "left_anti")
    once = stay.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return stay.join(repeated, same, "left_anti").unionByName(once)


def _judged(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    docs = docs.select("doc_id", "text")
    sketched = parked(sketches(docs, shingle_words))
    linkable = sketched.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = linkable.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n_shingles", "sketch", "bands")]
    )
    classes = parked(classes.withColumn("node", F.monotonically_increasing_id()))
    labels = _class_labels(docs, classes, shingle_words, percent)
    named = classes.select("key", "doc_id", "node").join(labels, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node")).select("key", "doc_id", "label")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = parked(named.join(least, "label").select("key", "component_id"))
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    columns = ["doc_id", "text_hash", "n_shingles"]
    found = sketched.filter(~alone).select(*columns, "key").join(named, "key").drop("key")
    rest = sketched.filter(alone).select(*columns, F.col("doc_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _class_labels(docs: DataFrame, classes: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """``node, label`` of the classes that have links."""
    members = classes.select(F.explode("bands").alias("bucket"), "node")
    # The member whose number is nearest to the bucket's by XOR: arbitrary, and another one in each bucket.
    nearest = members.groupBy("bucket").agg(
        F.min(F.col("node").bitwiseXOR(F.col("bucket"))).alias("centre"), F.count("*").alias("size")
    )
    centres = nearest.filter("size > 1").select("bucket", F.col("centre").bitwiseXOR(F.col("bucket")).alias("centre"), "size")
    members = parked(members.join(parked(centres), "bucket"))  # from a table, so that a hot bucket's join can be split

    summaries = parked(classes.join(bounded(members.select("node").distinct(), BROADCAST_ROWS), "node", "left_semi").select(
        "node", "key", "n_shingles", "sketch"
    ))
    starred = _candidates(members.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")), summaries, percent)
    starred = parked(starred)
    involved = parked(starred.select(F.col("a").alias("node")).union(starred.select("b")).distinct().join(summaries.select("node", "key"), "node"))
    owners = classes.select("key", "doc_id").join(involved, "key")
    texts = docs.join(bounded(owners.select("doc_id").distinct(), BROADCAST_ROWS), "doc_id", "left_semi")
    sets = shingle_sets(texts, shingle_words).join(bounded(involved, BROADCAST_ROWS), "key")
    sets = parked(sets.groupBy("node").agg(F.first("shingles").alias("shingles")))

    # Every member with the most similar of its centres.
    best = starred.groupBy("a").agg(F.min(F.struct("bits", "b")).alias("best")).select("a", "best.b")
    links = parked(_linked(best, sets, percent))
    labels = components(links)

    # With the centres that are still in other components.
    links = links.unionByName(parked(_linked(_apart(starred.select("a", "b"), labels), sets, percent)))
    labels = components(links)

    # Buckets that still hold several components: every member against the hub of the main one, then each other.
    there = members.filter("size > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    there = parked(there.select("bucket", "node", "label"))
    counts = there.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("labels"))
    # A table, so that the join of a hot bucket's members can be split.
    main = parked(main.filter("labels > 1").select("bucket", F.col("main.label").alias("main")))
    grouped = there.join(main, "bucket").select("node", "label", "main").distinct()
    degrees = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("n"))
    hubs = degrees.join(labels, "node").groupBy(F.col("label").alias("main")).agg(F.max(F.struct("n", "node")).alias("hub"))
    hubs = hubs.select("main", F.col("hub.node").alias("hub"))
    grouped = parked(grouped.join(hubs, "main", "left").withColumn("hub", F.coalesce("hub", "main")))
    if not grouped.limit(1).count():
        return labels
    sets = _with_missing(sets, grouped, docs, classes, shingle_words)
    close, pairs = _differences(grouped, sets, percent)
    links = links.unionByName(parked(close)).unionByName(parked(_linked(_candidates(pairs, summaries, percent), sets, percent)))
    return components(links)


def _differences(grouped: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links with the hub, and candidate pairs of members, both as ``a, b``.

    Two sets of n and m shingles are similar enough if they differ in at most T = (n + m) (100 - percent) / (100 +
    percent). Let D be what a set and the hub's do not have in common, so that two sets differ in what their Ds do not
    have in common. A pair can only be a link if its Ds share (|D| + |D'| - T) / 2, so the rarest that
    they share must come early in both, in order of rarity: edits that nobody else has rule out most pairs unseen.
    """
    pair = grouped.join(sets, "node").join(sets.withColumnsRenamed({"node": "hub", "shingles": "hub_shingles"}), "hub")
    lost, won = F.array_except("hub_shingles", "shingles"), F.array_except("shingles", "hub_shingles")
    pair = pair.select("hub", "main", "node", "label", F.size("shingles").alias("n"), F.size("hub_shingles").alias("m"), F.concat(lost, won).alias("d"))
    pair = parked(pair.withColumn("size", F.size("d")))
    close = pair.filter((100 + percent) * F.col("size") <= (100 - percent) * (F.col("n") + F.col("m"))).filter("node <> hub")
    opened = pair.select("hub", "main", "node", "label", "n", "size", F.explode("d").alias("shingle"))
    rarity = opened.groupBy("hub", "shingle").agg(F.count("*").alias("rarity"))
    placed = opened.join(rarity.filter("rarity > 1"), ["hub", "shingle"])
    # What only one set has comes first, and is never shared: the others are placed from the end.
    from_end = F.row_number().over(Window.partitionBy("hub", "node").orderBy(F.desc("rarity"), "shingle"))
    placed = parked(placed.withColumn("from_end", from_end).drop("rarity"))
    x = placed.filter("label <> main").select("hub", "shingle", *[F.col(c).alias(f"{c}_x") for c in ("main", "node", "label", "n", "size", "from_end")])
    y = placed.select("hub", "shingle", *[F.col(c).alias(f"{c}_y") for c in ("node", "label", "n", "size", "from_end")])
    both = F.col("n_x") + F.col("n_y")
    most = F.floor(both * (100 - percent) / (100 + percent))
    shared = F.greatest(F.ceil((F.col("size_x") + F.col("size_y") - most) / 2), F.lit(1))
    enough = (F.col("from_end_x") >= shared) & (F.col("from_end_y") >= shared)
    sizes = 100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")
    apart = F.expr("label_x <> label_y AND (label_y = main_x OR node_x < node_y)")
    same = (F.col("x.hub") == F.col("y.hub")) & (F.col("x.shingle") == F.col("y.shingle"))
    pairs = x.alias("x").join(y.alias("y"), same & apart & sizes & enough)
    pairs = pairs.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
    return close.select(F.col("node").alias("a"), F.col("hub").alias("b")), pairs


def _with_missing(sets: DataFrame, grouped: DataFrame, docs: DataFrame, classes: DataFrame, shingle_words: int) -> DataFrame:
    """The sets, with those of classes that no earlier pair had."""
    nodes = grouped.select("node").union(grouped.select("hub")).distinct()
    missing = parked(nodes.join(sets.select("node"), "node", "left_anti").join(classes.select("node", "key", "doc_id"), "node"))
    if not missing.limit(1).count():
        return sets
    texts = docs.join(bounded(missing.select("doc_id").distinct(), BROADCAST_ROWS), "doc_id", "left_semi")
    more = shingle_sets(texts, shingle_words).join(bounded(missing.select("key", "node"), BROADCAST_ROWS), "key")
    return sets.unionByName(parked(more.groupBy("node").agg(F.first("shingles").alias("shingles"))))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component."""
    for end in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")), end, "left")
        pairs = pairs.withColumn(f"l{end}", F.coalesce(f"l{end}", end))
    return pairs.filter("la <> lb").select("a", "b")


def _candidates(pairs: DataFrame, summaries: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose set sizes and sketches allow the similarity; ``bits`` is the sketches' difference."""
    pairs = pairs.distinct()
    for end in ("a", "b"):
        pairs = pairs.join(summaries.select(F.col("node").alias(end), F.col("n_shingles").alias(f"n{end}"), F.col("sketch").alias(f"s{end}")), end)
    bits = sum((F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    near = pairs.withColumn("bits", bits).filter(F.col("bits") <= most_bits(percent / 100 - MARGIN))
    return near.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "bits")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    wanted = bounded(parked(pairs.select("a", "b")), BROADCAST_ROWS)
    first = sets.withColumnsRenamed({"node": "a", "shingles": "sa"}).join(wanted, "a")
    both = first.join(sets.withColumnsRenamed({"node": "b", "shingles": "sb"}), "b")
    return both.filter(_similar("sa", "sb", percent)).select("a", "b")


def _similar(a: str, b: str, percent: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= percent * (F.size(a) + F.size(b) - common)

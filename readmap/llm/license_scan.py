"""License scan: an exact set-similarity join of text blocks with license templates, in SQL.

A block is ``WIDTH`` words of a document, and a new one begins every ``STRIDE`` words, so that every run of ``WIDTH -
STRIDE`` words is whole in some block. A template is contained in a block if enough of its distinct words are
there. Words are ordered by how often all documents have them, rarest first. A template that misses at most k words
must show one of its k + 1 first words, its prefix; only blocks that have a word of some prefix are kept.
Their template words, in the same order, have a prefix as well: pairs that share a prefix word, that are long
enough, and whose places in both orders leave room for the words that are needed, are compared word by word.

Notices of different licenses may differ in a word or two. Where the text of one is within the threshold of the other,
the words that only the other has decide: a block must have them for the other, and must not for the one.

Templates that are phrases need all their words, and count where these stand one after another.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmap.llm.common import parked

STRIDE, WIDTH = 64, 128
#: Share of a notice's distinct words that a block must have.
CONTAINMENT = 0.8
# Fixed value: what is a word, after A-Z have become lower case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases, whose places are counted, and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Sentences from the public texts of licenses and their notices, and the labels they give.
NOTICES = [
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under the gnu lesser general public license version 3", "lgpl"),
    ("you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
]


def needed(size: int, share: float) -> int:
    """The least number of words that is at least the share of ``size`` words."""
    return next(n for n in range(1, size + 1) if n >= share * size - 1e-9)


def words(text: str = "text") -> Column:
    """The words of a whole text; NULL has none."""
    return F.expr(f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}'), r'{WORD}', 0)")


def deciding(notices: list[tuple[str, str]], containment: float) -> list[tuple[list[str], list[str]]]:
    """For each notice, the words that a block must have, and those that it must not have, besides the threshold."""
    sets = [(set(text.split()), label) for text, label in notices]
    must, never = [set() for _ in sets], [set() for _ in sets]
    for one, (words_one, label_one) in enumerate(sets):
        for other, (words_other, label_other) in enumerate(sets):
            if label_one != label_other and len(words_one & words_other) >= needed(len(words_other), containment):
                must[other] |= words_other - words_one
                never[one] |= words_other - words_one
    return [(sorted(m), sorted(n)) for m, n in zip(must, never)]


def word_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How many times all documents have each word of a given, short list."""
    found = docs.select(F.explode(words()).alias("word")).filter(F.col("word").isin(vocabulary))
    return {row.word: row["count"] for row in found.groupBy("word").count().collect()}


def _literal(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def scan_licenses(docs: DataFrame, phrases=PHRASES, notices=NOTICES, containment: float = CONTAINMENT) -> DataFrame:
    """Per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of all phrases, ``first_word`` and ``last_word`` are the smallest and largest start
    of one, in words from 0, NULL without any. ``base_labels`` are the phrases' labels, ``labels`` those and the
    labels of the notices found, distinct, sorted, joined by commas. ``score`` is 1 with a phrase, else the largest
    share of a notice's words in a block, if that is ``containment`` or more, else 0. NULL texts are empty. Rows that
    repeat an id have each their own result. Only ``doc_id`` and ``text`` are read.
    """
    templates = [(text.split(), label, 1.0) for text, label in phrases]
    templates += [(text.split(), label, containment) for text, label in notices]
    if max(len(tokens) for tokens, _, _ in templates) > WIDTH - STRIDE:
        raise ValueError(f"templates may have {WIDTH - STRIDE} words")
    docs = docs.select("doc_id", "text")
    vocabulary = sorted({w for tokens, _, _ in templates for w in tokens})
    counts = word_counts(docs, vocabulary)
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}

    extra = [([], [])] * len(phrases) + deciding(notices, containment)
    rows, prefixes = [], set()
    for number, (tokens, label, share) in enumerate(templates):
        ranks = sorted({rank[w] for w in tokens})
        need = needed(len(ranks), share)
        prefix = ranks[: len(ranks) - need + 1]
        prefixes.update(order[r] for r in prefix)
        phrase = tokens if number < len(phrases) else None
        must, never = ([rank[w] for w in some] for some in extra[number])
        rows.extend((r, at, number, ranks, need, must, never, phrase, label) for at, r in enumerate(prefix))
    index = docs.sparkSession.createDataFrame(
        rows, "rank int, at int, template int, ranks array<int>, need int, must array<int>, never array<int>, phrase array<string>, label string"
    )

    blocks = parked(_blocks(docs, sorted(prefixes)))
    matched = parked(_matches(blocks, order, F.broadcast(index)))  # templates are a parameter, a few hundred rows
    places = matched.filter("phrase IS NOT NULL").select("doc_id", "text_hash", "label", F.explode(_places()).alias("word_no"))
    keys = ["doc_id", "text_hash"]
    base = places.distinct().groupBy(*keys).agg(
        F.count("*").alias("n_base"), F.min("word_no").alias("first_word"), F.max("word_no").alias("last_word"),
        F.collect_set("label").alias("found"), F.lit(1.0).alias("score"),
    )
    nothing = F.lit(None).cast("long")
    notice = matched.filter("phrase IS NULL").groupBy(*keys).agg(
        F.lit(0).cast("long").alias("n_base"), nothing.alias("first_word"), nothing.alias("last_word"),
        F.collect_set("label").alias("found"), F.max("share").alias("score"),
    )
    both = base.withColumn("base", F.col("found")).unionByName(notice.withColumn("base", F.array().cast("array<string>")))
    found = both.groupBy(*keys).agg(
        F.sum("n_base").alias("n_base"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
        F.flatten(F.collect_list("base")).alias("base"), F.flatten(F.collect_list("found")).alias("found"),
        F.max("score").alias("score"),
    )
    def joined(labels: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.coalesce(F.col(labels), F.array().cast("array<string>")))), ",")

    found = found.withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_text_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    return blocks.select("doc_id", "text_hash", "n_words").join(found, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        joined("base").alias("base_labels"), joined("found").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _blocks(docs: DataFrame, prefixes: list[str]) -> DataFrame:
    """``doc_id, text_hash, n_words`` of all documents, and of their blocks those with a prefix word."""
    rare = _literal(prefixes)
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words().alias("words"))
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size("words") - 1) / STRIDE), F.lit(0)).cast("int")),
        lambda b: F.struct(b.alias("block"), F.slice("words", b * STRIDE + 1, WIDTH).alias("tokens")),
    )
    kept = F.when(F.arrays_overlap("words", rare), F.filter(cut, lambda b: F.arrays_overlap(b["tokens"], rare)))
    return split.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), kept.alias("blocks"))


def _matches(blocks: DataFrame, order: list[str], index: DataFrame) -> DataFrame:
    """Pairs of a block and a template that it contains."""
    opened = blocks.filter("blocks IS NOT NULL").select("doc_id", "text_hash", F.inline("blocks")).distinct()
    known = _literal(order)
    ranked = F.array_sort(F.transform(F.array_intersect("tokens", known), lambda w: (F.array_position(known, w) - 1).cast("int")))
    opened = opened.withColumn("have", ranked)
    # Which part of a block's words is its prefix depends on the template: the pair is checked for it below.
    probes = opened.select("*", F.posexplode("have").alias("place", "rank"))
    met = probes.join(index, "rank")
    have, size = F.size("have"), F.size("ranks")
    room = F.least("at", "place") + 1 + F.least(size - F.col("at") - 1, have - F.col("place") - 1)
    met = met.filter((have >= F.col("need")) & (F.col("place") <= have - F.col("need")) & (room >= F.col("need")))
    common = F.size(F.array_intersect("have", "ranks"))
    met = met.filter(common >= F.col("need")).withColumn("share", common / size)
    met = met.filter((F.size(F.array_except("must", "have")) == 0) & ~F.arrays_overlap("never", "have"))
    return met.select("doc_id", "text_hash", "block", "tokens", "template", "phrase", "label", "share").distinct()


def _places() -> Column:
    """Places where the phrase begins in the block's own ``STRIDE`` words."""
    return F.expr(
        f"transform(filter(sequence(0, least({STRIDE}, size(tokens)) - 1), i -> slice(tokens, i + 1, size(phrase)) = phrase),"
        f" i -> cast(block * {STRIDE} + i as bigint))"
    )


def oracle(phrases=PHRASES, notices=NOTICES, containment: float = CONTAINMENT) -> str:
    """The same in DuckDB, with every block compared with every template."""
    def listed(tokens: list[str]) -> str:
        return "[" + ", ".join(f"'{t}'" for t in tokens) + "]"

    base = ", ".join(f"({listed(text.split())}, '{label}')" for text, label in phrases)
    more = ", ".join(
        f"({listed(sorted(set(text.split())))}, {needed(len(set(text.split())), containment)}, {listed(must)}::varchar[],"
        f" {listed(never)}::varchar[], '{label}')"
        for (text, label), (must, never) in zip(notices, deciding(notices, containment))
    )
    return f"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce("text", ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') as w
  from documents
), phrases(tokens, label) as (values {base}), notices(tokens, need, must, never, label) as (values {more}),
places as (
  select r, label, i from (select r, w, label, tokens, unnest(range(len(w))) as i from d, phrases)
  where w[i + 1:i + len(tokens)] = tokens
), b as (
  select r, count(*) as n_base, min(i) as first_word, max(i) as last_word, list(distinct label) as labels from places group by r
), blocks as (
  select r, list_distinct(w[k * {STRIDE} + 1:k * {STRIDE} + {WIDTH}]) as tokens
  from (select r, w, unnest(range(cast(ceil(len(w) / {STRIDE}) as bigint))) as k from d)
), n as (
  select r, list(distinct label) as labels, max(share) as score
  from (select r, label, need, len(list_intersect(blocks.tokens, notices.tokens)) as common,
               len(list_intersect(blocks.tokens, notices.tokens)) / len(notices.tokens) as share from blocks, notices
        where list_has_all(blocks.tokens, must) and not list_has_any(blocks.tokens, never))
  where common >= need group by r
)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base,
       cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(n.labels, [])))), ','), '') as labels,
       cast(case when b.r is not null then 1.0 else coalesce(n.score, 0.0) end as double) as score
from d left join b on b.r = d.r left join n on n.r = d.r
"""

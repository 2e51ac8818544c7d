"""From ``documents`` to packed sequences: quality, lines, near duplicates, benchmark passages, packing.

Each stage takes all rows that the stage before kept, as a table, and returns a table; all but the last
return the columns that they were given. NULL texts count as empty.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readmap.llm import decontamination, line_dedup, near_duplicates, packing, quality
from readmap.llm.common import fresh, parked, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labels of these documents, does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "_quality")
    return quality.scored(docs, model, score).filter(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document or line has; those that keep no line go.

    ``n_chars`` follows where a text gets shorter. A document that was blank before stays.
    """
    before = fresh(docs, "_text")
    found = line_dedup.without_repeated_lines(docs.withColumn(before, F.col("text")), shortest=1)
    changed = ~F.col("text").eqNullSafe(F.col(before))
    found = found.filter(~changed | (F.regexp_replace("text", r"[\x00-\x20]+", "") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: two-word shingles, as in the operator's query, similarity 0.8.

    Lines that documents share are gone by now, and a changed word costs five of the longer shingles: with five words, next
    to no near copy is left that would reach 0.8.
    """
    return near_duplicates.without_near_duplicates(docs, shingle_words=2, percent=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of 1024 ids."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", own_lines),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("best-fit packing", packed),
]

# The classifier is trained and the tokenizer is a program: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = parked(docs)
    return docs

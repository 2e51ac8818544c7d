"""One query per operator, over whole tables, and the SQL for those that SQL can express."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readmap.llm import fill_in_middle, html_text, license_scan, ordered_packing, packing, quality, ranked_search, token_file, topk_search
from readmap.llm.line_dedup import line_report
from readmap.llm.near_duplicates import near_duplicates
from readmap.llm.common import table
from readmap.llm.decontamination import contaminated
from readmap.llm.repeats import repeated_spans
from readmap.scratch import shared_folder


def op1_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best vectors by inner product for each vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").filter(topk_search.usable("embedding"))
    vectors = vectors.select("vec_id", topk_search.quantised("embedding").alias("vector"))
    return topk_search.top_k(vectors.filter("vec_id % 100 = 0"), vectors, k=10)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by a classifier fitted on labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in each document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op4_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of documents that are a benchmark item within a few edits."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that an earlier line repeats, exactly or, if they are long, within two edits."""
    return line_report(table(spark, sf_dir, "documents"), shortest=1)


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as token ids and read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    listing = token_file.write_token_files(docs, shared_folder(spark), public_tokenizers.path("word_bpe_49k.json"))
    return token_file.read_token_files(spark, listing).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of 1024 ids."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    pages = table(spark, sf_dir, "pages")
    return html_text.extracted(pages, html_text.fit(pages))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of documents that other documents have as well."""
    return repeated_spans(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op11_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents, in order, in sequences of 2048 ids."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return ordered_packing.pack_in_order(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=1)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its middle behind its suffix, and back, as digests."""
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), seed=1)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES = {
    f.__name__: f
    for f in (
        op1_top_k_search,
        op2_quality_classifier,
        op3_license_scan,
        op4_benchmark_passages,
        op5_line_dedup,
        op6_token_file,
        op7_best_fit_packing,
        op8_html_text,
        op9_repeated_passages,
        op10_near_duplicates,
        op11_ordered_packing,
        op12_fill_in_middle,
        op13_ranked_search,
    )
}

ORACLES = {
    "op3_license_scan": license_scan.oracle(),
    "op12_fill_in_middle": fill_in_middle.oracle(),
    "op13_ranked_search": ranked_search.oracle(),
    "op1_top_k_search": """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as c
  from embeddings
  where vec_id is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)
), s as (
  select q.vec_id as query_id, q.c, d.vec_id,
         cast(list_sum(list_transform(list_zip(q.c, d.c), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) as bigint) as score
  from (select distinct vec_id, c from v) q join v d on q.vec_id % 100 = 0 and q.vec_id <> d.vec_id
), r as (
  select *, cast(row_number() over (partition by query_id, c order by score desc, vec_id) as int) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 10
""",
}

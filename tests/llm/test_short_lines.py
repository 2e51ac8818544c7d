import corpus_pipeline
from readmap.llm import line_dedup as ld
from readmap.llm import queries
from test_line_dedup import EDGES

LONG, OTHER = "a line that is long enough", "another line, and a longer one"
DOCS = {
    1: f"Les.\n{LONG}\nGes.",
    2: f"Les.\n{LONG}\nGes.",  # a whole copy
    3: f" Les.\t\n\n{OTHER}\nBes.\nBes.",
    4: f"{LONG}!\nGes.\nNew.",
    5: "Ges.\n \nLes.",
    6: " \n",
}
LEFT = {1: DOCS[1], 2: "", 3: f"\n{OTHER}\nBes.", 4: "New.", 5: " ", 6: " \n"}


def rows(spark):
    return spark.createDataFrame([(d, t, len(t)) for d, t in DOCS.items()], "doc_id long, text string, n_chars int")


def test_short_lines_repeat_as_exact_copies(spark):
    got = {r.doc_id: (r.n_exact, r.n_near, r.n_removed) for r in ld.line_report(rows(spark), shortest=1).collect()}
    assert got == {1: (0, 0, 0), 2: (3, 0, 3), 3: (2, 0, 2), 4: (1, 1, 2), 5: (2, 0, 2), 6: (0, 0, 0)}
    assert {r.doc_id: r.text for r in ld.without_repeated_lines(rows(spark), shortest=1).collect()} == LEFT


def test_pipeline_keeps_no_scraps_of_copies(spark):
    left = corpus_pipeline.own_lines(spark, rows(spark), "")
    assert {r.doc_id: (r.text, r.n_chars) for r in left.collect()} == {d: (t, len(t)) for d, t in LEFT.items() if d not in (2, 5)}


def test_query_reports_every_exact_copy(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    seen, want = set(), {}
    for d, text in sorted(docs.items()):
        lines = [x for x in (EDGES.sub("", x) for x in text.split("\n")) if x]
        want[d] = 0
        for x in lines:
            want[d] += x in seen
            seen.add(x)
    assert {r.doc_id: r.n_exact for r in queries.op5_line_dedup(spark, sf).collect()} == want

import numpy as np
import public_tokenizers
import pytest
from brute_force import near_components
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from readmap.llm import line_dedup, quality
from readmap.llm.common import parked, table
from readmap.llm.decontamination import Index
from test_line_dedup import brute as repeated_lines
from test_packing import check


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, found = table(spark, sf, "documents"), {}
    found["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = parked(stage(spark, docs, sf))
    return found


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_names_and_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "best-fit packing"]
    assert all(stages[name].columns == stages["documents"].columns for name in names[:-1])


def test_quality(spark, sf, stages):
    model = quality.fit(table(spark, sf, "documents"), table(spark, sf, "labels"))
    want = {d: t for d, t in texts(stages["documents"]).items() if model.score(t.encode()) >= quality.THRESHOLD}
    assert texts(stages["quality classifier"]) == want and len(want) < stages["documents"].count()


def test_lines(stages):
    before = texts(stages["quality classifier"])
    removed, _ = repeated_lines(before, shortest=1)
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in removed) for d, t in before.items()}
    assert texts(stages["line dedup"]) == {d: t for d, t in want.items() if t.strip() or not before[d].strip()}
    assert removed
    assert stages["line dedup"].filter("n_chars <> length(text)").count() == 0


def test_near_duplicates(stages):
    before = texts(stages["line dedup"])
    want = near_components(before, 2, 80)
    assert texts(stages["MinHash near-dedup"]) == {d: t for d, t in before.items() if want[d] == d}


def test_benchmark(spark, sf, stages):
    items = [(r.item_id, r.text.encode()) for r in table(spark, sf, "benchmark").collect()]
    before = texts(stages["MinHash near-dedup"])
    kept = texts(stages["benchmark decontamination"])
    index = Index(items)
    assert kept == {d: t for d, t in before.items() if not index.find([t.encode()])} and len(kept) < len(before)
    assert not any(item.decode() in t for t in kept.values() for _, item in items)


def test_packing(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts(stages["benchmark decontamination"]).items()}
    rows = stages["best-fit packing"].collect()
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == sizes
    assert check(rows, 1024) <= 1.05 * np.ceil(sum(sizes.values()) / 1024)


def test_unusual_documents(spark, sf, tmp_path):
    line = "A line that is long enough to take part here."
    data = [(None, None), (1, ""), (2, line), (2, line), (3, line), (None, line), (4, "w " * 40_000), (5, "plain words stand in this text " * 30)]
    docs = spark.createDataFrame([(*d, "en", 1.0, 2) for d in data], "doc_id long, text string, label string, score double, n_chars int")
    for name in ("labels", "benchmark"):
        table(spark, sf, name).write.parquet(f"{tmp_path}/{name}.parquet")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            before, rows = rows, parked(stage(spark, rows, str(tmp_path)))
        assert (rows.count() > 0) == (before.count() > 0)


def test_run(spark, sf, stages):
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, stages["best-fit packing"].select(*columns).collect()))
    assert got.agg(F.count_distinct("sequence_id")).first()[0] == stages["best-fit packing"].agg(F.count_distinct("sequence_id")).first()[0]
    assert line_dedup.EDITS == 2

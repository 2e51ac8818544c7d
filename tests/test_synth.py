"""How reads and masks are made from tables: in how many tasks, in which order, and how often."""

import pytest
from pyspark.sql import functions as F

from readmap import synth
from readmap.operators.barcodes import captured_counts
from readmap.operators.layout import ReadLayout
from readmap.operators.pairing import mate1, mate2


@pytest.fixture
def tables(spark, tmp_path):
    """A thousand events and customers, some of them twice or without number, in one file of one task each."""
    number = F.when(F.col("id") % 97 != 0, F.col("id") - F.col("id") % 50 % 2)
    rows = spark.range(0, 1000, 1, 1)
    rows.select(number.alias("event_id"), (F.col("id") % 30).alias("user_id")).write.parquet(f"{tmp_path}/events.parquet")
    rows.select(number.alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_a_small_file_is_made_into_reads_by_many_tasks(spark, tables, monkeypatch):
    monkeypatch.setattr(synth, "TASK_ROWS", 100)
    first, second = synth.mates(spark, tables)
    parts = F.spark_partition_id().alias("part")
    one, two = ([(r.part, r.name) for r in mate.select(parts, "name").collect()] for mate in (first, second))
    assert one == two and len(one) == 1000  # files of both mates are in step
    assert len({part for part, _ in one}) > 5
    assert synth.mask(spark, tables).select(parts).distinct().count() > 5


def test_filters_on_reads_do_not_make_them_again(spark, tables):
    pairs = synth.with_errors(synth.pairs(spark, tables))
    first = mate1(synth.mate(pairs, 1), ReadLayout()).filter("NOT umi_bad OR short1")
    second = mate2(synth.mate(pairs, 2), ReadLayout(), synth.ADAPTERS).filter("NOT adapter")
    keys = synth.mask(spark, tables).filter("barcode IS NOT NULL").select("barcode").distinct()
    # Barcode, UMI and qualities of read 1; two halves of sequence and of qualities of read 2; the barcode of a mask.
    for table, digests in ((captured_counts(first), 3), (second, 4), (keys, 1)):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("md5(") == digests, plan

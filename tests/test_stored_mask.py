import os
import re

import pytest

from readmap import map_barcodes, place_files, store_mask, stored_mask, synth
from readmap.operators.layout import ReadLayout
from readmap.plans import one_pass
from readmap.sinks import fastq_lines


def moved(frame):
    """What the exchanges of a plan move, as their output columns."""
    return re.findall(r"Exchange hashpartitioning", frame._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def stored(spark, sf, tmp_path):
    return store_mask(synth.mask(spark, sf), str(tmp_path / "stored"), 8)


def test_rows_and_files(spark, sf, tmp_path, stored):
    mask = synth.mask(spark, sf)
    assert sorted(map(tuple, stored.select("barcode", "x", "y").collect())) == sorted(map(tuple, mask.collect()))
    firsts = [r.barcode for r in stored.filter("first").collect()]
    assert sorted(firsts) == sorted({r.barcode for r in mask.collect()})
    assert len([f for f in os.listdir(tmp_path / "stored") if f.startswith("part-")]) <= 8
    with pytest.raises(Exception, match="(?i)exists|non-empty"):
        store_mask(mask, str(tmp_path / "stored"), 8)
    with pytest.raises(ValueError):
        store_mask(mask, str(tmp_path / "other"), 0)


def test_another_session_finds_it_by_its_path(spark, sf, tmp_path, stored):
    spark.sql(f"DROP TABLE {stored_mask_name(spark, tmp_path)}")
    again = stored_mask(spark, str(tmp_path / "stored"), 8)
    assert again.count() == synth.mask(spark, sf).count()


def stored_mask_name(spark, tmp_path):
    from readmap.sources.stored_mask import _table_name

    return _table_name(str(tmp_path / "stored"))


def test_a_mapping_does_not_move_the_mask(spark, sf, stored, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    reads1, reads2 = synth.mates(spark, sf)
    plain = map_barcodes(synth.mask(spark, sf), reads1, reads2, adapters=synth.ADAPTERS, mode="DROP").tagged
    mapped = map_barcodes(stored, reads1, reads2, adapters=synth.ADAPTERS, mode="DROP").tagged
    assert len(moved(plain)) == 4 and len(moved(mapped)) == 3  # read 1 by barcode, both mates by name
    assert sorted(map(tuple, mapped.collect())) == sorted(map(tuple, plain.collect()))


def test_one_pass_does_not_move_the_mask(spark, sf, tmp_path, stored, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    paths = []
    for k, mate in enumerate(synth.mates(spark, sf), 1):
        fastq_lines(synth.suffixed(mate)).coalesce(1).write.text(f"{tmp_path}/{k}")
        paths.append(f"{tmp_path}/{k}")
    rows = one_pass.read_fastq_pairs(spark, *paths)
    for lookup, moves in ((stored, 1), (synth.mask(spark, sf), 2)):
        table = one_pass._with_homes(lookup)
        assert len(moved(one_pass._counted(rows, table, [], ReadLayout(), "sanger"))) >= moves
    assert len(moved(one_pass._counted(rows, one_pass._with_homes(stored), [], ReadLayout(), "sanger"))) == 1
    counts = [place_files(spark, *paths, lookup, f"{tmp_path}/out{k}", adapters=synth.ADAPTERS) for k, lookup in enumerate((stored, synth.mask(spark, sf)))]
    assert counts[0] == counts[1] and counts[0]["mapped"] == 420

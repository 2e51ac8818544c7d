import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from checks.compare import connect
from readmap.llm.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, name, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    sql = connect(sf).sql(ORACLES[name])
    frame = QUERIES[name](spark, sf).select(*sql.columns)
    assert sorted(map(repr, (tuple(r) for r in frame.collect()))) == sorted(map(repr, sql.fetchall()))


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_contract_columns(spark, sf):
    wanted = {
        "op2": ["doc_id", "held_out", "score", "predicted"],
        "op6": ["doc_id", "start", "n_tokens", "ids_crc32"],
        "op7": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        "op8": ["page_id", "url", "text", "n_chars"],
        "op10": ["doc_id", "n_shingles", "component_id", "kept"],
        "op11": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        "op12": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
        "op13": ["item_id", "rank", "doc_id", "score"],
    }
    for name, query in QUERIES.items():
        if columns := wanted.get(name.split("_")[0]):
            assert query(spark, sf).columns == columns


def test_rest_works_without_the_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('readmap.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'map_barcodes' in e.queries() and not any(n.startswith('op') and n[2].isdigit() for n in e.queries())\n"
        "assert 'pipeline' not in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)

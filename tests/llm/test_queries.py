"""The registered queries against DuckDB, and what they promise to return."""

import os
import shutil
import subprocess
import sys

import pytest
from oracle import connect, duck_rows, spark_rows

from casecast.llm.oracles import ORACLES
from casecast.llm.queries import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COLUMNS = {
    "op1": "doc_id bigint, fingerprint string, component_id bigint",
    "op2": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op3": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op4": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op5": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op7": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op8": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double",
    "op9": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op13": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string",
    "op12": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op11": "item_id bigint, rank int, doc_id bigint, score bigint",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(duck, ORACLES[name])


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns(spark, sf_dir, number):
    (name,) = [name for name in QUERIES if name.startswith(f"{number}_")]
    types = [f"{column} {kind}" for column, kind in QUERIES[name](spark, sf_dir).dtypes]
    assert types[: len(COLUMNS[number].split(", "))] == COLUMNS[number].split(", ")


def test_registered_next_to_the_others():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_the_rest_stands_without_the_subpackage(tmp_path):
    kept = tmp_path / "repo"
    shutil.copytree(REPO, kept, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; assert 'base_rates' in e.queries() and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=kept, check=True, env=os.environ | {"PYTHONPATH": str(kept)})

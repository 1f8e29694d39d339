import subprocess
import sys

import pytest

from quillmark import oracles
from quillmark import queries as editorial
from tests.oracle import assert_same


@pytest.mark.parametrize("name", sorted(editorial.queries()))
def test_query_equals_its_sql(spark, name):
    assert_same(spark, editorial.queries()[name], oracles.ORACLES[name])


def test_every_query_has_sql():
    assert set(editorial.queries()) == set(oracles.ORACLES)


def test_entry_gives_rows(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["doc_id", "ord", "line"] and df.count() > 0


def test_the_rest_works_without_the_subpackage():
    """With the training-data operators out of reach, the entry still has the other queries."""
    code = "import sys; sys.modules['quillmark.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'layout_checks' in e.queries() and not any(q.startswith('op1_') for q in e.queries()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True)

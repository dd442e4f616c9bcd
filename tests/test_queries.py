import pytest

import __spark_entry__ as entry_points
import oracle

# The extra operators have tests of their own.
QUERIES = {n: q for n, q in entry_points.queries().items() if n not in entry_points.LLM_QUERIES}
ORACLES = {n: s for n, s in entry_points.oracle_sql().items() if n not in entry_points.LLM_ORACLES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["split", "batch_id", "block_id", "ids_md5", "labels_md5", "n_ids"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, sf_dir, name, capsys):
    df = QUERIES[name](spark, sf_dir)
    df.explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "BatchEvalPython" not in plan
    assert "Window" not in plan or "SinglePartition" not in plan
    assert oracle.actual(df) == oracle.expected(duck, ORACLES[name])

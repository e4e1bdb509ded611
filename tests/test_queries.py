"""Every registered query against its oracle, and what the plans must not contain."""

import os
import subprocess
import sys

import pytest
from helpers import plan
from oracle import connect, differences

import __spark_entry__ as registered

QUERIES = registered.queries()
ORACLE = registered.oracle_sql()


@pytest.fixture(scope="module")
def con(smoke_dir):
    return connect(smoke_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, smoke_dir, con, name):
    assert differences(QUERIES[name](spark, smoke_dir), con, ORACLE[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


PLAIN = sorted(set(ORACLE) - {"similar_topk", "similar_topk_blocks"})


@pytest.mark.parametrize("name", [n for n in PLAIN if not n.startswith("stream")])
def test_no_python_and_no_cross_join(spark, smoke_dir, name):
    text = plan(QUERIES[name](spark, smoke_dir))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, word


def test_scans_read_only_what_is_needed(spark, smoke_dir):
    text = plan(QUERIES["rate_by_type"](spark, smoke_dir))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in text
    assert "l_extendedprice" not in text and "o_orderdate" not in text
    # Without balances the customer and supplier tables are not touched.
    assert "customer.parquet" not in text and "supplier.parquet" not in text


def test_entry(spark):
    df = registered.entry(spark)
    assert df.count() > 0 and "fraud_probability" in df.columns


ELSEWHERE = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("given_entry", sys.argv[1])
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
from ledgerlens.session import local_session
spark = local_session(cores=2, partitions=2)
queries = module.queries()
print("rows", *[queries[n](spark, sys.argv[2]).count() for n in ("similar_topk", "similar_topk_blocks")])
"""


def test_tasks_do_not_need_the_package(tmp_path, smoke_dir):
    """Started from another folder, the Python workers cannot import the package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", ELSEWHERE, registered.__file__, smoke_dir],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert "rows 30 30" in done.stdout, done.stderr[-2000:]

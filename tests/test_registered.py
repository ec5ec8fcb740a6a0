"""Registered queries against their SQL on the smallest data folder."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.queries import SQL
from tools.compare import connect, normal

ROOT = "/root/testdata/sf0.001"
# The training-data operators have tests of their own.
CHOSEN = [name for name in SQL if name in oracle_sql()]

pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="test data is not here")


@pytest.fixture(scope="module")
def duck():
    return connect(ROOT)


@pytest.mark.parametrize("name", CHOSEN)
def test_equals_sql(spark, duck, name):
    result = queries()[name](spark, ROOT)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert normal([tuple(r) for r in result.collect()], result.columns) == normal(cursor.fetchall(), columns)


PROBE = """
import sys
import __spark_entry__ as entry
from marquee.session import build_session
spark = build_session("probe", "local[2]", **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"})
rows = entry.queries()["content_scores"](spark, sys.argv[1]).count()
print("ROWS", rows, len(entry.oracle_sql()))
"""


def test_workers_import_the_package_from_another_folder(tmp_path):
    """The repository is on the driver's path alone; the workers start elsewhere."""
    home = str(Path(__file__).resolve().parent.parent)
    code = f"import sys; sys.path.insert(0, {home!r})\n" + PROBE
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_users_do_not_move_by_region(spark):
    plan = queries()["recommend_all"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [region" in plan
    assert plan.count("hashpartitioning(region") == 1  # the lists of titles, a row per region


def test_entry(spark):
    assert entry(spark).count() > 0

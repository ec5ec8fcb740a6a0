"""Single requests from the stored layout: same result as over the whole tables, and few files and rows read."""

import pytest
from pyspark.sql import functions as F

from checks import queries as Q
from marquee.plans import serving
from marquee.plans.recommend import recommend

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "v1")
    serving.write_layout(Q.serving(spark, ROOT), path, buckets=5)
    return serving.Requests(spark, path)


def test_requests_equal_the_job_for_all_users(spark, layout):
    everyone = {}
    for r in recommend(Q.serving(spark, ROOT)).collect():
        everyone.setdefault(r.user_id, []).append(tuple(r))
    users = sorted(r.user_id for r in Q.serving(spark, ROOT).users.collect())
    busy = sorted(everyone, key=lambda u: -len(everyone[u]))[:3]
    for user in [*busy, users[-1]]:
        assert sorted(map(tuple, layout.recommend(user).collect())) == sorted(everyone.get(user, []))


def test_unknown_users_get_nothing(layout):
    for user in ("nobody", "", "'"):
        assert layout.recommend(user).count() == 0


def scanned(rows):
    """(files, rows) that the scan of a plan without shuffles read."""
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    while not plan.children().isEmpty():
        plan = plan.children().head()
    metrics = plan.metrics()
    return metrics.get("numFiles").get().value(), metrics.get("numOutputRows").get().value()


def test_a_request_reads_few_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(serving, "ROW_GROUP_BYTES", 10_000)
    tables = Q.serving(spark, ROOT)
    n = 40_000
    users = spark.range(n).select(
        F.concat(F.lit("u"), F.lpad(F.col("id").cast("string"), 10, "0")).alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("region"),
        F.lit("en").alias("preferred_language"), F.lit("PG").alias("maturity_rating"),
    )
    tables.users = users
    serving.write_layout(tables, str(tmp_path / "v1"), buckets=4)
    requests = serving.Requests(spark, str(tmp_path / "v1"))
    files, rows = scanned(requests.rows("users", ["u0000000777"]))
    assert files == 1 and rows < n / 4 / 3
    assert requests.rows("users", ["u0000000777"]).count() == 1
    assert requests.rows("items", []).count() == 0

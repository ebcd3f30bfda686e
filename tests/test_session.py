"""Registered queries run in a session of their own that sends only small tables to all tasks."""

from voxlake import registry
from voxlake.plans.register import BROADCAST, MOST, own_session


def test_only_small_tables_are_sent(spark, sf_dir):
    before = spark.conf.get(BROADCAST)
    df = registry.QUERIES["a15_distinct_labels"](spark, sf_dir)
    assert df.sparkSession.conf.get(BROADCAST) == str(MOST) and spark.conf.get(BROADCAST) == before
    assert df.sparkSession.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    mine = own_session(spark)
    rows = mine.range(400_000).selectExpr("id", "id * 7919 % 1000003 as v")
    path = mine.conf.get("spark.checkpoint.dir") + "/session-rows"
    rows.write.mode("overwrite").parquet(path)
    plan = lambda s: (t := s.read.parquet(path)).join(t.selectExpr("v as id", "id as w"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(spark) and "BroadcastHashJoin" not in plan(mine)


def test_no_broadcast_stays(spark):
    off = spark.newSession()
    off.conf.set(BROADCAST, "-1")
    assert own_session(off).conf.get(BROADCAST) == "-1"


def test_numbered_operators_too(spark, sf_dir):
    """Counts of words fit 10 MB of files long before they fit a driver."""
    from __spark_entry__ import queries

    before = spark.conf.get(BROADCAST)
    df = queries()["op11_spelling_variants"](spark, sf_dir)
    assert df.sparkSession.conf.get(BROADCAST) == str(MOST) and spark.conf.get(BROADCAST) == before

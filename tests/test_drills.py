"""End-to-end compositions on the smallest driver tables."""

import datetime as dt

from pyspark.sql import functions as F

from harborlens.plans import bindings as b
from harborlens.plans import drills
from harborlens.sources.tables import Tables
from tests.conftest import SF_SMALL


def test_readiness_check(spark):
    t = Tables(spark, SF_SMALL)
    out = drills.readiness_check(b.endpoints_expected(t), b.endpoints_actual(t), "item", {"want": "attr"},
                                 group="want")
    items = out["items"].count()
    total = out["summary"].agg(F.sum(F.col("n_pass") + F.col("n_fail"))).first()[0]
    assert items == total == t.orders.count()


def test_resource_audit(spark):
    t = Tables(spark, SF_SMALL)
    out = drills.resource_audit(b.cloud_sources(t), {"Project": "p1", "Environment": "dev"},
                                b.expected_resources(t))
    in_scope = out["scope"].where("in_scope").count()
    leaked = out["leaks"].agg(F.sum("leaked")).first()[0] or 0
    assert 0 <= leaked <= in_scope < out["inventory"].count()


def test_backup_restore_drill(spark, scratch):
    t = Tables(spark, SF_SMALL)
    out = drills.backup_restore_drill(b.objects_before(t), b.objects_after(t), "k", ["1-URGENT"], "n1",
                                      dt.datetime(2024, 1, 1), scratch + "/bk", status_rows=b.phases(t),
                                      as_of=dt.datetime(2001, 9, 1))
    assert out["backup"].count() == out["restored"].count() > 0
    statuses = {r.status for r in out["verify"].select("status").distinct().collect()}
    assert statuses == {"same", "missing", "extra", "changed"}
    assert out["jobs"].count() == t.orders.count()


def test_queue_drill(spark):
    t = Tables(spark, SF_SMALL)
    out = drills.queue_drill(b.deliveries(t), b.jobs(t), step_s=3600, cooldown_s=7200)
    assert out["deduplicated"].count() == t.events.count()
    assert out["demand"].count() == out["backlog"].count()
    assert out["stability"].agg(F.sum("polls")).first()[0] == out["demand"].count()


def test_command_line_lists_every_query(capsys):
    from harborlens.__main__ import main
    from harborlens.plans.catalog import all_queries
    assert main(["list"]) == 0
    listed = {line.split()[0] for line in capsys.readouterr().out.splitlines() if line.strip()}
    assert listed == set(all_queries())
    assert main(["run", "no_such_query"]) == 2

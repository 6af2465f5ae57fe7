"""Open alerts by generation, failures consumed once, alerts closed by hand."""

import pytest

from tests.helpers import SETTINGS, at, frame
from wattledger import schemas
from wattledger.plans import alert_pass, housekeeping
from wattledger.plans.store import Store
from wattledger.sinks import tables as sinks
from wattledger.sources.files import Folder

FAILED = "PIPELINE_TASK_FAILED"
SCOPE = "billing.bill_day"


def log(spark, store, seconds, state="failed", error="boom", task="bill_day"):
    row = ("billing", task, 3, state, error if state == "failed" else None, at(seconds))
    sinks.append_run_log(frame(spark, schemas.RUN_LOG, row), store.run_log_path)


def beat(spark, store, seconds):
    for name in SETTINGS.expected_components:
        row = (name, at(seconds), "OK", "")
        sinks.upsert_heartbeat(frame(spark, schemas.HEARTBEAT, row), store.heartbeats_path)


@pytest.fixture
def run(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    number = iter(range(1000))

    def one(seconds):
        changes = alert_pass.run_alert_pass(spark, store, at(seconds), next(number), SETTINGS)
        return sorted((r.scope, r.transition) for r in changes.collect() if r.alert_type == FAILED)

    one.store = store
    return one


def test_a_failure_raises_one_alert_and_a_closed_one_stays_closed(spark, run):
    store = run.store
    log(spark, store, 10, "success")
    assert run(20) == []
    log(spark, store, 30)
    log(spark, store, 31, task="other")
    assert run(40) == [(SCOPE, "triggered"), ("billing.other", "triggered")]
    # Neither later passes nor a success touch it.
    log(spark, store, 45, "success")
    assert run(50) == [] and run(60) == []
    assert store.open_alerts(spark).where(f"alert_type = '{FAILED}'").count() == 2
    assert alert_pass.close_alert(spark, store, FAILED, SCOPE, at(65)) == 1
    assert run(70) == [(SCOPE, "resolved")]
    assert run(80) == [] and run(90) == []
    assert [r.scope for r in store.open_alerts(spark).collect() if r.alert_type == FAILED] == ["billing.other"]
    # A later failure is another alert, and a failure after a closure keeps its alert open.
    log(spark, store, 95, error="again")
    assert run(100) == [(SCOPE, "triggered")]
    alert_pass.close_alert(spark, store, FAILED, SCOPE, at(105))
    log(spark, store, 107, error="and again")
    assert run(110) == [(SCOPE, "refreshed")] and run(120) == []
    rows = [r for r in store.alerts(spark).collect() if (r.alert_type, r.scope) == (FAILED, SCOPE)]
    assert sorted(r.resolved for r in rows) == [False, True] and len({r.id for r in rows}) == 2
    assert any("and again" in r.message for r in rows)
    assert alert_pass.close_alert(spark, store, FAILED, "nobody", at(130)) == 0


def test_what_a_pass_reads_does_not_grow(spark, run):
    store = run.store
    for i in range(12):
        if i % 3 == 0:
            beat(spark, store, i * 400)
        run(i * 400 + 100)
        assert len(store.open_alerts(spark).inputFiles()) <= 1
        housekeeping.sweep(spark, store, SETTINGS)
        assert len(Folder(spark, store.open_alerts_path).names("pass=*")) <= 3
    rows = store.alerts(spark).collect()
    assert len({r.id for r in rows}) == len(rows) and any(r.resolved for r in rows)


def test_a_repeated_pass_and_an_unfinished_one(spark, run):
    store = run.store
    log(spark, store, 10)
    run(20)
    before = sorted(map(str, store.alerts(spark).collect()))
    alert_pass.run_alert_pass(spark, store, at(20), 0, SETTINGS)
    assert sorted(map(str, store.alerts(spark).collect())) == before
    # Resolved by a pass that never got as far as its open alerts: not seen.
    alert_pass.close_alert(spark, store, FAILED, SCOPE, at(25))
    run(30)
    folder = Folder(spark, store.open_alerts_path)
    folder.drop("pass=000000000001/_SUCCESS")
    assert sorted(map(str, store.alerts(spark).collect())) == before
    alert_pass.run_alert_pass(spark, store, at(30), 1, SETTINGS)
    assert store.alerts(spark).where(f"alert_type = '{FAILED}' AND resolved").count() == 1

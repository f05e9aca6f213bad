"""One erase of a table at a time."""

import threading
import time

import pytest

from tessera import fsutil
from tessera.operators import erase as E
from tessera.operators import lease as L
from tessera.session import scratch_path
from tests.test_erase_golden import ANDY, CITIZENS, PETER, ROSE, make_table, reqs


def test_of_many_callers_one_holds(spark):
    path, held, busy = scratch_path(spark, "lease") + "/x.lease", [], []

    def call():
        try:
            with L.Lease(spark, path):
                held.append(1)
                time.sleep(1.0)
        except L.Busy:
            busy.append(1)
    threads = [threading.Thread(target=call) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(held) == 1 and len(busy) == 5
    assert not fsutil.exists(spark, path)
    with L.Lease(spark, path), pytest.raises(L.Busy), L.Lease(spark, path, wait=0.3):
        pass


def test_a_waiting_call_gets_its_turn(spark):
    path = scratch_path(spark, "lease") + "/x.lease"
    first = L.Lease(spark, path).__enter__()
    threading.Timer(0.5, lambda: first.__exit__()).start()
    with L.Lease(spark, path, wait=20) as second:
        assert second.holds()


def test_an_expired_lease_is_taken_over_and_its_holder_stops(spark, monkeypatch):
    path = scratch_path(spark, "lease") + "/x.lease"
    dead = L.Lease(spark, path)
    assert fsutil.create_new(spark, path, f"{dead.owner} {time.time() - 2 * L.LEASE_SECONDS}".encode())
    with L.Lease(spark, path) as now:
        assert now.holds() and not dead.holds()
        dead.__exit__()
        assert now.holds()
    monkeypatch.setattr(L, "LEASE_SECONDS", 1.0)
    with L.Lease(spark, path):
        time.sleep(2.5)                              # renewed all the while
        with pytest.raises(L.Busy), L.Lease(spark, path):
            pass


@pytest.mark.parametrize("swap", ["relocate", "copy", "files"])
def test_a_second_call_is_refused_at_every_step(spark, monkeypatch, swap):
    t = make_table(spark)
    refused, at = [], E._Stop.at

    def and_call_again(self, step):
        if step not in refused:
            with pytest.raises(L.Busy):
                E.erase_records(spark, t, reqs(spark, [ROSE]), key="nin", swap=swap)
            refused.append(step)
        at(self, step)
    monkeypatch.setattr(E._Stop, "at", and_call_again)
    report = E.erase_records(spark, t, reqs(spark, [ANDY, PETER]), key="nin", swap=swap)
    assert refused == list(E.STEPS) and not report.resumed
    assert spark.table(t).count() == len(CITIZENS) - 2
    monkeypatch.undo()
    report = E.erase_records(spark, t, reqs(spark, [ROSE]), key="nin", swap=swap)
    assert not report.resumed and spark.table(t).count() == len(CITIZENS) - 3


@pytest.mark.parametrize("step", E.STEPS)
def test_a_call_that_lost_its_lease_stops_and_the_next_resumes(spark, monkeypatch, step):
    """The holder hangs at a step until its lease expired and another call took over."""
    t = make_table(spark)
    at = E._Stop.at

    def hang(self, now):
        if now == step and self.lease is not None:
            fsutil.write_bytes(spark, self.lease.path, b"another 0")
        at(self, now)
    monkeypatch.setattr(E._Stop, "at", hang)
    with pytest.raises(L.Busy, match="taken over"):
        E.erase_records(spark, t, reqs(spark, [ANDY, PETER]), key="nin", swap="copy")
    monkeypatch.undo()
    E.erase_records(spark, t, reqs(spark, [ROSE]), key="nin", swap="copy")
    assert sorted(r.nin for r in spark.table(t).collect()) == sorted(
        c[0] for c in CITIZENS if c[0] not in (30234324, 30234323, 30234328))

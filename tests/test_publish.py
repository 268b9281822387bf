from __future__ import annotations

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import fresh, rows
from wardlens.plans import (compute_indicators, publish_indicators, publish_periods,
                            read_indicators, sweep_published)
from wardlens.sources.model import Tables
from wardlens.sources.versions import Conflict, VersionedTable

P1 = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
P2 = (dt.date(2024, 1, 15), dt.date(2024, 2, 15))  # overlaps P1


def _model(make, n_enc):
    deps = make("departments", [{"DepartmentID": 1, "DepartmentName": "A", "BedCapacity": 3}])
    pts = make("patients", [{"PatientID": 1, "Zip": "12307"}])
    staff = make("staff", [{"StaffID": 1, "DepartmentID": 1, "Role": "nurse",
                            "EmploymentStatus": "active"}])
    enc = make("encounters", [
        {"EncounterID": i, "PatientID": 1, "DepartmentID": 1, "EncounterType": "inpatient",
         "EncounterDate": dt.date(2024, 1, 20 + i), "DischargeDate": dt.date(2024, 1, 22 + i)}
        for i in range(n_enc)])
    return Tables(departments=deps, patients=pts, staff=staff, encounters=enc)


def test_rerun_replaces_only_the_period(spark, make):
    root = fresh(spark, "test-publish")
    m = _model(make, 3)
    ind1 = compute_indicators(m, *P1, computed_on=dt.date(2024, 3, 1))
    n1 = ind1.count()
    publish_indicators(ind1, root, *P1)
    publish_indicators(ind1, root, *P1)  # rerun: no duplicates
    assert read_indicators(spark, root, *P1).count() == n1
    assert rows(read_indicators(spark, root, *P1)) == rows(ind1)

    ind2 = compute_indicators(m, *P2, computed_on=dt.date(2024, 3, 1))
    publish_indicators(ind2, root, *P2)
    assert read_indicators(spark, root).count() == n1 + ind2.count()
    assert read_indicators(spark, root, *P1).count() == n1  # overlapping period kept

    # a rerun over data with no encounters clears the indicator rows of P1
    empty = compute_indicators(_model(make, 0), *P1, computed_on=dt.date(2024, 3, 2))
    assert empty.count() == 0
    publish_indicators(empty, root, *P1)
    assert read_indicators(spark, root, *P1).count() == 0
    assert read_indicators(spark, root, *P2).count() == ind2.count()


def test_failed_publish_keeps_the_old_period(spark, make, monkeypatch):
    root = fresh(spark, "test-publish-failure")
    m = _model(make, 3)
    ind = compute_indicators(m, *P1, computed_on=dt.date(2024, 3, 1))
    publish_indicators(ind, root, *P1)
    before = rows(read_indicators(spark, root, *P1))
    newer = compute_indicators(m, *P1, computed_on=dt.date(2024, 4, 1))

    def failing(self, path, text):
        raise OSError("injected")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_put_if_absent", failing)
        with pytest.raises(OSError):
            publish_indicators(newer, root, *P1)
    assert rows(read_indicators(spark, root, *P1)) == before
    broken = newer.withColumn("ComputedValue", F.raise_error(F.lit("injected")).cast("double"))
    with pytest.raises(Exception, match="injected"):
        publish_indicators(broken, root, *P1)
    assert rows(read_indicators(spark, root, *P1)) == before


def test_readers_never_see_a_gap_or_two_copies(spark, make):
    """A reader that loops while a period is published 20 times."""
    root = fresh(spark, "test-publish-readers")
    ind = compute_indicators(_model(make, 3), *P1, computed_on=dt.date(2024, 3, 1))
    publish_indicators(ind, root, *P1)
    want, seen, done = ind.count(), [], threading.Event()

    def read():
        while not done.is_set():
            seen.append(read_indicators(spark, root, *P1).count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for _ in range(20):
            publish_indicators(ind, root, *P1)
    finally:
        done.set()
        reader.join()
    assert seen and set(seen) == {want}
    table = VersionedTable(spark, root)
    assert table.newest() == 21 and len(table._names(f"{root}/data")) == 21
    assert sweep_published(spark, root, dt.timedelta(days=1)) == 0
    assert sweep_published(spark, root, dt.timedelta(seconds=-60)) == 20
    assert read_indicators(spark, root, *P1).count() == want


def test_of_two_writers_one_wins(spark):
    table = VersionedTable(spark, fresh(spark, "test-versions"))
    assert table.parts() == {} and table.commit(0, {"a": "data/1", "b": "data/2"}) == 1
    # Both start from version 1: another part goes through, the same part does not.
    assert table.commit(1, {"a": "data/3"}) == 2
    assert table.commit(1, {"c": "data/4"}) == 3
    with pytest.raises(Conflict):
        table.commit(1, {"a": "data/5"})
    assert table.parts() == {"a": "data/3", "b": "data/2", "c": "data/4"}
    assert table.commit(3, {"b": None}) == 4 and "b" not in table.parts()
    assert table.parts(1) == {"a": "data/1", "b": "data/2"}
    with ThreadPoolExecutor(8) as pool:
        def attempt(i):
            try:
                table.commit(4, {"a": f"data/new{i}"})
                return i
            except Conflict:
                return None
        won = [x for x in pool.map(attempt, range(8)) if x is not None]
    assert len(won) == 1 and table.parts()["a"] == f"data/new{won[0]}"


def test_several_periods_in_one_step(spark, make):
    root = fresh(spark, "test-publish-several")
    m = _model(make, 3)
    both = [compute_indicators(m, *p, computed_on=dt.date(2024, 3, 1)) for p in (P1, P2)]
    none = (dt.date(1999, 1, 1), dt.date(1999, 1, 31))
    publish_periods(both[0].unionByName(both[1]), root, [P1, P2, none])
    assert VersionedTable(spark, root).newest() == 1
    assert rows(read_indicators(spark, root, *P1)) == rows(both[0])
    assert rows(read_indicators(spark, root, start=P2[0])) == rows(both[1])
    assert read_indicators(spark, root, *none).count() == 0


def test_rows_of_another_period_are_refused(spark, make):
    root = fresh(spark, "test-publish-other")
    ind = compute_indicators(_model(make, 3), *P1, computed_on=dt.date(2024, 3, 1))
    publish_indicators(ind, root, *P1)
    before = rows(read_indicators(spark, root, *P1))
    with pytest.raises(ValueError):
        publish_indicators(ind, root, *P2)
    assert rows(read_indicators(spark, root)) == before


def test_published_types(spark, make):
    root = fresh(spark, "test-publish-types")
    m = _model(make, 2)
    ind = compute_indicators(m, *P1, computed_on=dt.date(2024, 3, 1))
    publish_indicators(ind, root, *P1)
    back = read_indicators(spark, root, *P1)
    assert back.schema == ind.schema or [f.dataType for f in back.schema] == [
        f.dataType for f in ind.schema]

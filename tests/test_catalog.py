import datetime as dt
import os
import uuid

import pytest

from skyloom.operators.checks import unequal
from skyloom.plans import pipeline
from skyloom.plans.state import Store
from skyloom.sources import catalog, discovery

START = dt.datetime(2026, 7, 1)


def make_search(folder, n=300, size=7):
    """A search over records that start every 37 minutes and last for an hour; it notes each call as a file."""

    def search(concept, start, end, page):
        open(os.path.join(folder, f"{start.replace(':', '')}_{page}_{uuid.uuid4().hex}"), "w").close()
        at = [dt.datetime(2026, 7, 1) + dt.timedelta(minutes=37 * k) for k in range(n)]
        shape = "%Y-%m-%dT%H:%M:%SZ"
        inside = [k for k in range(n) if at[k].strftime(shape) < end and (at[k] + dt.timedelta(hours=1)).strftime(shape) >= start]
        # Every page gives its last record again as the first of the next one, as when records move while they are read.
        here = inside[max((page - 1) * size - 1, 0) : page * size] if (page - 1) * size < len(inside) else []
        times = lambda k: {"BeginningDateTime": at[k].strftime(shape), "EndingDateTime": (at[k] + dt.timedelta(hours=1)).strftime(shape)}
        return [{"meta": {"native-id": f"g{k}", "revision-date": f"2026-07-20T00:00:{page:02d}Z"}, "umm": {"TemporalExtent": {"RangeDateTime": times(k)}}, "links": [{"href": f"https://h/{k}.nc"}]} for k in here]

    return search


def test_slices_and_pages_give_what_one_search_gives(spark, tmp_path):
    search = make_search(str(tmp_path))
    end = START + dt.timedelta(days=8)

    def whole(concept, start, stop):
        pages = iter(lambda c=iter(range(1, 1000)): search(concept, start, stop, next(c)), [])
        return [r for p in pages for r in p]

    want = discovery.discover(spark, whole, "C1", start=START, end=end).drop("cmr_revision_at").distinct()
    got = catalog.discover_paged(spark, search, "C1", slice_hours=5, start=START, end=end)
    assert got.count() == 300 and unequal(got.drop("cmr_revision_at"), want).count() == 0
    store = Store(spark, str(tmp_path / "store"))
    assert pipeline.discover(store, got, START) == {"found": 300, "inserted": 300, "refreshed": 0}
    assert pipeline.discover(store, got, START) == {"found": 300, "inserted": 0, "refreshed": 300}


def test_each_slice_is_a_partition_and_filters_spare_searches(spark, tmp_path):
    spark.dataSource.register(catalog.catalog_source(make_search(str(tmp_path))))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        read = spark.read.format("catalog").options(concept_id="C1", start="2026-07-01T00:00:00Z", end="2026-07-03T03:00:00Z", slice_hours="6", prune="true")
        rows = read.load()
        assert rows.rdd.getNumPartitions() == 9 and {r.slice_start for r in rows.select("slice_start").distinct().collect()} == {START + dt.timedelta(hours=6 * k) for k in range(9)}
        assert rows.agg({"slice_end": "max"}).first()[0] == dt.datetime(2026, 7, 3, 3)
        for f in os.listdir(tmp_path):
            os.remove(tmp_path / f)
        late = read.load().where("slice_start >= timestamp_ntz '2026-07-02 12:00:00' and slice_start < timestamp_ntz '2026-07-03 00:00:00'")
        assert late.count() > 0 and {f.split("_")[0] for f in os.listdir(tmp_path)} == {"2026-07-02T120000Z", "2026-07-02T180000Z"}
        assert read.load().where("slice_start > timestamp_ntz '2030-01-01 00:00:00'").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_bad_windows_and_searches_that_never_end_are_errors(spark):
    same = lambda concept, start, end, page: [{"granule_ur": "a"}]
    with pytest.raises(Exception, match="again as page 2"):
        catalog.discover_paged(spark, same, "C1", start=START, end=START + dt.timedelta(hours=1)).count()
    with pytest.raises(Exception, match="need a length"):
        catalog.discover_paged(spark, same, "C1", slice_hours=0, start=START, end=START + dt.timedelta(hours=1)).count()
    none = catalog.discover_paged(spark, lambda *_: [], "C1", start=START, end=START + dt.timedelta(hours=1))
    assert none.count() == 0

"""Production path = verified plans: every report over the catalog tables (written by
refine_all, registered, repaired) equals the same-named registered plan, which starts from
the raw observation table and is checked against SQL."""

from roadpulse.operators import emergency as E
from roadpulse.plans.inputs import comparable
from roadpulse.reports import REPORTS, run_report
from roadpulse.schemas import EMERGENCY, FEEDS
from roadpulse.session import scratch_dir
from roadpulse.sources import catalog as C
from roadpulse.sources import storage as S
from roadpulse.sources.feeds import derive_feed
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_report_equals_its_plan(spark):
    import __spark_entry__ as entry
    base = scratch_dir(spark, "reports")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for feed in FEEDS:
        S.write_raw_batch(derive_feed(ev, feed), feed, base)
    status = {r.feed: r.status for r in S.refine_all(spark, base, f"{base}/ref").collect()}
    assert set(status.values()) == {"OK"}
    db = "rep_" + base.rsplit("-", 1)[-1]
    C.ensure_database(spark, db, f"{base}/_db")
    C.register_tables(spark, db, f"{base}/ref", strict=True)
    for feed in FEEDS:
        C.repair_partitions(spark, db, feed)
    tables = {f: C.scan(spark, db, f) for f in FEEDS}
    plans = entry.queries()
    checked = 0
    for name in REPORTS:
        kw = {"as_of": E.latest_date(tables[EMERGENCY])} if name == "active_incidents" else {}
        got = comparable(run_report(name, tables, **kw))
        want = plans[name](spark, SF_SMALL)
        assert got.columns == want.columns, name
        assert _rows(got) == _rows(want), name
        checked += 1
    assert checked == len(REPORTS) >= 30

"""The command line in processes of their own, as submitted."""

import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from roadpulse.schemas import EMERGENCY, FEEDS
from roadpulse.sources.feeds import derive_feed
from roadpulse.sources.storage import write_raw_batch
from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SUBMITTED = "--master local[2] --conf spark.sql.shuffle.partitions=77 --conf spark.ui.enabled=false pyspark-shell"


def _run(*argv, code=None):
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": SUBMITTED, "PYTHONPATH": ROOT}
    args = [sys.executable, "-c", code] if code else [sys.executable, "-m", "roadpulse", *argv]
    return subprocess.run(args, env=env, cwd=ROOT, capture_output=True, text=True, timeout=180)


def test_refine_and_report_in_their_own_processes(spark, tmp_base):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for feed in FEEDS:
        write_raw_batch(derive_feed(events, feed), feed, tmp_base.removeprefix("file:"))
    base = tmp_base.removeprefix("file:")
    done = _run("refine", "--raw", base, "--refined", base)
    assert done.returncode == 0, done.stderr[-800:]
    assert {s["status"] for s in json.loads(done.stdout.strip().splitlines()[-1])} == {"OK"}
    out = f"{base}/report"
    done = _run("report", "incidents_by_day", "--refined", base, "--out", out)
    assert done.returncode == 0, done.stderr[-800:]
    assert spark.read.parquet(out).agg(F.sum("total_events")).first()[0] == 1000
    shown = _run("report", "incidents_by_day", "--refined", base, "--show", "2")
    assert "more rows of" in shown.stdout
    top = _run("report", "top_incident_vehicles", "--refined", base, "--n", "3", "--out", out)
    assert top.returncode == 0 and spark.read.parquet(out).count() == 3
    lost = _run("report", "incidents_by_day", "--db", "nowhere")
    assert lost.returncode != 0 and "persistent catalog" in lost.stderr


def test_the_submitted_settings_hold():
    done = _run(code="from roadpulse.__main__ import _session; s = _session(); "
                     "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    assert "GOT local[2] 77 UTC" in done.stdout, done.stderr[-800:]


def test_report_needs_a_source():
    assert EMERGENCY in FEEDS
    done = _run("report", "incidents_by_day")
    assert done.returncode == 2 and "--db or --refined" in done.stderr

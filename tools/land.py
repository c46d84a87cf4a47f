"""Test input: the five feeds derived from an observation table, published as wire records.

  python tools/land.py <events parquet> <landing folder>
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def land(spark, events_path: str, landing: str) -> None:
    from roadpulse.schemas import FEEDS
    from roadpulse.session import run_concurrently
    from roadpulse.sources.feeds import derive_feed
    from roadpulse.sources.wire import encode
    from roadpulse.streaming.ingest import publish

    events = spark.read.parquet(events_path)
    done = run_concurrently({f: (lambda f=f: publish(encode(derive_feed(events, f), f), landing, f)) for f in FEEDS})
    for result in done.values():
        if isinstance(result, Exception):
            raise result


if __name__ == "__main__":
    from roadpulse.session import build_session

    land(build_session(), *sys.argv[1:3])

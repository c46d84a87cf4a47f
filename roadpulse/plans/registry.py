"""Named plans: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators import dashboard as D
from roadpulse.operators import emergency as E
from roadpulse.operators import refine as P
from roadpulse.operators import vehicle as V
from roadpulse.plans.inputs import comparable, events, raw, refined
from roadpulse.schemas import EMERGENCY, FEED_SCHEMAS, FEEDS, GPS, TRAFFIC, VEHICLE, WEATHER
from roadpulse.sources.feeds import derive_feed
from roadpulse.sources.wire import decode, encode
from roadpulse.functions.rules import humidity_ok, lat_lon, speed_ok, temperature_ok
from roadpulse.operators import temporal as X
from roadpulse.operators.quantiles import merged_percentiles, sketch_table
from roadpulse.plans import streams as ST
from roadpulse.session import run_concurrently, scratch_dir
from roadpulse.sources import catalog as C
from roadpulse.sources import storage as S
from roadpulse.sources.published import NO_DATE
from roadpulse.sources.feeds import feed_exprs, observations
from roadpulse.sources.wire import split_dead_letters
from roadpulse.streaming import ingest as I
from roadpulse.streaming import operators as SO
from roadpulse.streaming.status import StreamStatus

Plan = Callable[[SparkSession, str], DataFrame]
PLANS: dict[str, Plan] = {}
SHORT = {VEHICLE: "vehicle", GPS: "gps", TRAFFIC: "traffic", WEATHER: "weather", EMERGENCY: "emergency"}


def plan(name: str):
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Plan:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        PLANS[name] = run
        return run
    return register


def _v(s, d):
    return refined(s, d, VEHICLE)


def _w(s, d):
    return refined(s, d, WEATHER)


def _e(s, d):
    return refined(s, d, EMERGENCY)


def _once(df: DataFrame, name: str) -> DataFrame:
    """A refined feed a plan reads twice (rows + a scalar subquery) is written once to the
    shared checkpoint folder and read back, as production reads refined tables: the dedup
    shuffle runs once, and the second read touches only the columns it needs."""
    return S.materialize(df, f"refined-{name}")


# ---- sources / wire -------------------------------------------------------------------
for _feed in FEEDS:
    plan(f"derive_{SHORT[_feed]}")(lambda s, d, f=_feed: raw(s, d, f))
    plan(f"refine_{SHORT[_feed]}")(lambda s, d, f=_feed: refined(s, d, f))


@plan("decode_roundtrip")
def _decode_roundtrip(s, d):
    """S13 -> S2: vehicle rows encoded to JSON and decoded back."""
    return decode(encode(raw(s, d, VEHICLE), VEHICLE), VEHICLE)


@plan("timestamp_cast")
def _timestamp_cast(s, d):
    """The text of a record's time on the wire, and the timestamp it becomes."""
    wire = encode(raw(s, d, GPS), GPS, keep=("id",)).select(F.col("id").alias("_id"), "value", F.get_json_object("value", "$.timestamp").alias("text"))
    typed = F.from_json("value", FEED_SCHEMAS[GPS])
    return wire.select(F.col("_id").alias("id"), F.substring("text", 1, 19).alias("text"), typed["timestamp"].alias("timestamp"))


@plan("feed_registry")
def _feed_registry(s, d):
    """Every feed refined by the function its name stands for, with the columns the registry declares."""
    parts = [P.REFINERS[feed](raw(s, d, feed)) for feed in FEEDS]
    declared = [", ".join(f.name for f in S.refined_read_schema(feed).fields) for feed in FEEDS]
    rows = [p.select(*names.split(", ")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(feed).alias("feed"), F.lit(names).alias("columns"), "rows")
            for feed, p, names in zip(FEEDS, parts, declared, strict=True)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


# ---- cleaning -------------------------------------------------------------------------
@plan("dedup_id")
def _dedup_id(s, d):
    return P.dedup(raw(s, d, VEHICLE))


@plan("valid_speed")
def _valid_speed(s, d):
    return raw(s, d, GPS).filter(speed_ok("speed"))


@plan("valid_weather")
def _valid_weather(s, d):
    return raw(s, d, WEATHER).filter(temperature_ok() & humidity_ok())


# ---- vehicle analytics ----------------------------------------------------------------
plan("speed_by_make_fuel")(lambda s, d: V.speed_by_make_fuel(_v(s, d)))
plan("speed_by_hour")(lambda s, d: V.speed_by_hour(_v(s, d)))
plan("speed_by_hour_sketch")(lambda s, d: V.speed_by_hour(_v(s, d), method="sketch"))
plan("ev_share_by_date")(lambda s, d: V.ev_share_by_date(_v(s, d)))
plan("top_models")(lambda s, d: V.top_models(_v(s, d)))
plan("speed_by_weather")(lambda s, d: V.speed_by_weather(_v(s, d), _w(s, d)))
plan("daily_kpi")(lambda s, d: V.daily_kpi(_v(s, d), _w(s, d), _e(s, d)))
plan("speed_by_make")(lambda s, d: V.speed_by_make(_v(s, d)))
plan("daily_kpi_exact")(lambda s, d: V.daily_kpi_exact(_v(s, d), _w(s, d), _e(s, d)))

# ---- emergency analytics --------------------------------------------------------------
plan("incidents_by_day")(lambda s, d: E.incidents_by_day(_e(s, d)))


@plan("active_incidents")
def _active_incidents(s, d):
    """E2 with 'today' = the newest date present in the data, as the write of the refined table observed it:
    no scan looks for it, and one directory is read."""
    base = scratch_dir(s, "active")
    dates = [x for x in S.write_refined(_e(s, d), EMERGENCY, base).dates if x != NO_DATE]
    return E.active_incidents(S.read_refined(s, EMERGENCY, base), as_of=max(dates, default=""))


@plan("active_incidents_today")
def _active_incidents_today(s, d):
    """E2, F12 as the report runs by default: the incidents of the newest date, dated today."""
    e = _once(_e(s, d), "emergency")
    newest = e.agg(F.max("date")).scalar()
    return E.active_incidents(e.withColumn("date", F.when(F.col("date") == newest, F.date_format(F.current_date(), "yyyy-MM-dd")).otherwise(F.col("date"))))


plan("resolution_rate")(lambda s, d: E.resolution_rate(_e(s, d)))
plan("incidents_by_hour_of_day")(lambda s, d: E.incidents_by_hour_of_day(_e(s, d)))
plan("top_incident_vehicles")(lambda s, d: E.top_incident_vehicles(_e(s, d)))
plan("active_incident_feed")(lambda s, d: E.active_incident_feed(_e(s, d)))

# ---- dashboard datasets ---------------------------------------------------------------
plan("latest_vehicle")(lambda s, d: D.latest(_v(s, d), D.VEHICLE_COLUMNS))
plan("latest_weather")(lambda s, d: D.latest(_w(s, d), D.WEATHER_COLUMNS))
plan("latest_emergency")(lambda s, d: D.latest(_e(s, d), D.EMERGENCY_COLUMNS))
plan("kpi_row")(lambda s, d: D.kpi_row(_v(s, d), _w(s, d), _e(s, d)))
plan("speed_timeline")(lambda s, d: D.speed_timeline(_once(_v(s, d), "vehicle")))
plan("mean_speed_by_hour")(lambda s, d: D.mean_speed_by_hour(_v(s, d)))
plan("make_counts")(lambda s, d: D.value_counts(_v(s, d), "make"))
plan("fuel_share")(lambda s, d: D.value_counts(_once(_v(s, d), "vehicle"), "fuelType", share=True))
plan("speed_mean_max_by_make")(lambda s, d: D.speed_mean_max_by_make(_v(s, d)))
plan("weather_series")(lambda s, d: D.weather_series(_w(s, d)))
plan("condition_share")(lambda s, d: D.value_counts(_once(_w(s, d), "weather"), "weatherCondition", share=True,
                                                    label="condition"))
plan("aqi_counts")(lambda s, d: D.value_counts(_w(s, d), "aqi_category", label="category"))
plan("incident_type_counts")(lambda s, d: D.incident_type_counts(_e(s, d)))
plan("active_table")(lambda s, d: D.active_table(_e(s, d)))
plan("incident_timeline")(lambda s, d: D.incident_timeline(_e(s, d)))


# the dashboard's own scope: the newest 500 rows of each table
plan("kpi_row_newest")(lambda s, d: D.kpi_row(*(D.latest_rows(t(s, d)) for t in (_v, _w, _e))))
plan("fuel_share_newest")(lambda s, d: D.value_counts(_once(D.latest_rows(_v(s, d)), "vehicle"), "fuelType", share=True))
plan("condition_share_newest")(lambda s, d: D.value_counts(_once(D.latest_rows(_w(s, d)), "weather"), "weatherCondition", share=True,
                                                           label="condition"))
plan("active_table_newest")(lambda s, d: D.active_table(D.latest_rows(_e(s, d))))
plan("incident_timeline_newest")(lambda s, d: D.incident_timeline(D.latest_rows(_e(s, d))))


def queries() -> dict[str, Plan]:
    return dict(PLANS)


# ---- storage, catalog ----------------------------------------------------------------
@plan("raw_roundtrip")
def _raw_roundtrip(s, d):
    """Raw vehicle rows written as Parquet and read back with the registry schema."""
    base = scratch_dir(s, "raw")
    S.write_raw_batch(raw(s, d, VEHICLE), VEHICLE, base)
    return S.read_raw(s, VEHICLE, base)


@plan("refined_write_read")
def _refined_write_read(s, d):
    """Refined vehicle written partitioned by date, read back with date as STRING."""
    base = scratch_dir(s, "refined")
    S.write_refined(_v(s, d), VEHICLE, base)
    return S.read_refined(s, VEHICLE, base)


@plan("catalog_pruned_scan")
def _catalog_pruned_scan(s, d):
    """Refined emergency -> database -> external table -> partition repair ->
    scan pruned to the newest date -> active real incidents of that date (E2)."""
    base = scratch_dir(s, "catalog")
    S.write_refined(_e(s, d), EMERGENCY, base)
    db = "roadpulse_" + base.rsplit("-", 1)[-1]
    C.ensure_database(s, db, f"{base}/_db")
    C.register_tables(s, db, base, (EMERGENCY,), strict=True)
    C.repair_partitions(s, db, EMERGENCY)
    # the newest date comes from the catalog's partition list and is a literal, so only its
    # directory is listed and read
    return E.active_incidents(C.scan(s, db, EMERGENCY), as_of=C.newest_partition(s, db, EMERGENCY))


@plan("refine_all_status")
def _refine_all_status(s, d):
    """Every feed raw -> refined in one call; per-feed status and row count."""
    base = scratch_dir(s, "refine-all")
    ev = events(s, d)
    landed = run_concurrently({f: (lambda f=f: S.write_raw_batch(derive_feed(ev, f), f, base)) for f in FEEDS})
    for result in landed.values():
        if isinstance(result, Exception):
            raise result
    return S.refine_all(s, base, base)


@plan("stream_ingest")
def _stream_ingest(s, d):
    """Five concurrent streams (landing -> decode -> watermark -> raw Parquet),
    then a per-feed summary of what reached the raw layer."""
    landing = ST.land(s, d, FEEDS)
    base = scratch_dir(s, "ingest")
    I.run_ingest(s, landing, base, FEEDS, trigger=ST.AVAILABLE_NOW)
    parts = [S.read_raw(s, feed, base)
             .agg(F.count(F.lit(1)).alias("records"), F.count_distinct("id").alias("ids"),
                  F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"))
             .select(F.lit(feed).alias("feed"), "*") for feed in FEEDS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- extensions ------------------------------------------------------------------------
@plan("lat_lon")
def _lat_lon(s, d):
    """Location text -> latitude / longitude doubles."""
    lat, lon = lat_lon("location")
    return _v(s, d).select("id", "location", lat.alias("lat"), lon.alias("lon"))


@plan("stream_dedup")
def _stream_dedup(s, d):
    """Vehicle stream deduplicated within the watermark."""
    landing = ST.land(s, d, (VEHICLE,))
    return ST.run_to_parquet(s, SO.stream_dedup(ST.decoded_stream(s, landing, VEHICLE)), "dedup")


@plan("stream_refine")
def _stream_refine(s, d):
    """Vehicle stream refined on the fly, sink partitioned by date."""
    landing = ST.land(s, d, (VEHICLE,))
    stream = SO.stream_refine(ST.decoded_stream(s, landing, VEHICLE), VEHICLE)
    return ST.run_to_parquet(s, stream, "refine", partition_by=["date"],
                             read_schema=S.refined_read_schema(VEHICLE))


@plan("stream_incident_timeline")
def _stream_incident_timeline(s, d):
    """Hourly incident counts per type from the emergency stream (tumbling windows)."""
    landing = ST.land(s, d, (EMERGENCY,), end_marker=True)
    stream = SO.hourly_incidents(SO.stream_refine(ST.decoded_stream(s, landing, EMERGENCY), EMERGENCY))
    return ST.before_end(ST.run_to_parquet(s, stream, "timeline"), "timestamp")


@plan("stream_sliding_speed")
def _stream_sliding_speed(s, d):
    """10-minute windows every 5 minutes over the refined vehicle stream."""
    landing = ST.land(s, d, (VEHICLE,), end_marker=True)
    stream = SO.sliding_speed(SO.stream_refine(ST.decoded_stream(s, landing, VEHICLE), VEHICLE))
    return ST.before_end(ST.run_to_parquet(s, stream, "sliding"), "window_start")


@plan("stream_join_weather")
def _stream_join_weather(s, d):
    """X11: refined vehicle stream x refined weather stream, same vehicle, within 5 minutes."""
    landing = ST.land(s, d, (VEHICLE, WEATHER))
    v = SO.stream_refine(ST.decoded_stream(s, landing, VEHICLE), VEHICLE)
    w = SO.stream_refine(ST.decoded_stream(s, landing, WEATHER), WEATHER)
    return ST.run_to_parquet(s, SO.join_weather(v, w), "join")


@plan("stream_trips")
def _stream_trips(s, d):
    """X6 on a stream: trips as session windows over the refined vehicle stream, in five micro-batches."""
    r = raw(s, d, VEHICLE)
    batch = ST.by_time(r, 5)
    files = ST.files_a_batch(r, batch)
    landing = ST.land_batches(s, r, VEHICLE, batch, 5, files=files, end_marker=True)
    stream = SO.stream_trips(SO.stream_refine(ST.one_file_stream(s, landing, VEHICLE, files), VEHICLE))
    return ST.before_end(ST.run_to_parquet(s, stream, "trips"), "trip_start")


@plan("stream_late_rows")
def _stream_late_rows(s, d):
    """T5: vehicle records in five batches by time, every 50th two batches late; which rows the split ingest
    keeps and which it puts aside as late. Kept and late rows are all rows."""
    r = raw(s, d, VEHICLE)
    step = F.substring("id", 5, 20).cast("long")
    batch = F.least(F.lit(4), ST.by_time(r, 5) + F.when(step % 50 == 7, 2).otherwise(0))
    files = ST.files_a_batch(r, batch)
    landing, base = ST.land_batches(s, r, VEHICLE, batch, 5, files=files), scratch_dir(s, "late")
    topic = I.read_topic(s, VEHICLE, landing=landing, max_files_per_trigger=files)
    I.await_all(s, [I.write_split(topic, VEHICLE, base, trigger=ST.AVAILABLE_NOW, late_after="2 minutes")])
    late = s.read.parquet(I.late_path(base, VEHICLE))
    return (S.read_raw(s, VEHICLE, base).select("id", "timestamp", F.lit(False).alias("late"))
            .unionByName(late.select("id", "timestamp", F.lit(True).alias("late"))))


@plan("stream_recovery")
def _stream_recovery(s, d):
    """Five micro-batches through the file sink, stopped between write and commit of the last one, and
    through the split ingest, stopped after batch 2 wrote its folders; both go on from their
    checkpoints. Each sink holds every record once."""
    r = raw(s, d, VEHICLE)
    batch = ST.by_time(r, 5)
    files = ST.files_a_batch(r, batch)
    landing = ST.land_batches(s, r, VEHICLE, batch, 5, files=files)
    file_base, split_base = scratch_dir(s, "recovered-file"), scratch_dir(s, "recovered-split")
    topic = I.read_topic(s, VEHICLE, landing=landing, max_files_per_trigger=files)
    for _ in range(2):
        I.await_all(s, [I.write_raw(I.decode_stream(topic, VEHICLE), VEHICLE, file_base, trigger=ST.AVAILABLE_NOW)])
        ST.forget_last_commit(s, I.checkpoint_path(file_base, VEHICLE))
    split = I.split_batch(VEHICLE, split_base)

    def stopped(batch, batch_id):
        split(batch, batch_id)
        if batch_id == 2:
            raise InterruptedError("stopped between write and commit")

    ended = (topic.writeStream.option("checkpointLocation", I.checkpoint_path(split_base, VEHICLE)).trigger(**ST.AVAILABLE_NOW)
             .foreachBatch(stopped).start())
    try:
        I.await_all(s, [ended])
    except RuntimeError as e:
        if "stopped between write and commit" not in str(e):
            raise
    I.await_all(s, [I.write_split(topic, VEHICLE, split_base, trigger=ST.AVAILABLE_NOW)])
    return (S.read_raw(s, VEHICLE, file_base).withColumn("sink", F.lit("file"))
            .unionByName(S.read_raw(s, VEHICLE, split_base).withColumn("sink", F.lit("split"))))


@plan("stream_rejects")
def _stream_rejects(s, d):
    """X12 on streams: rows each range rule rejects, as the micro-batches of three feeds report them."""
    status, queries = StreamStatus(s, scratch_dir(s, "status")), []
    for feed in (VEHICLE, GPS, WEATHER):
        r, out = raw(s, d, feed), scratch_dir(s, "observed")
        batch = ST.by_time(r, 3)
        files = ST.files_a_batch(r, batch)
        landing = ST.land_batches(s, r, feed, batch, 3, files=files)
        stream = SO.observed_refine(ST.one_file_stream(s, landing, feed, files), feed)
        queries.append(I.write_stream(stream, f"{out}/data", f"{out}/checkpoint", trigger=ST.AVAILABLE_NOW))
        status.watch(queries[-1], feed)
    I.await_all(s, queries)
    status.close()
    return status.rejected().groupBy("feed", "rule").agg(F.sum("rejected").alias("rejected"), F.sum("checked").alias("checked"))


@plan("speed_by_hour_merged")
def _speed_by_hour_merged(s, d):
    """F8, V2 from a sketch table: per (date, hour) sketches kept as a table, merged per hour, and whether the
    medians and 95th percentiles lie within 3 % of the rows' ranks."""
    v = _once(_v(s, d), "vehicle")
    path = scratch_dir(s, "speed-sketches")
    sketch_table(v, ["date", "hour"], "speed_kmh").write.partitionBy("date").parquet(path)
    merged = merged_percentiles(s.read.parquet(path), ["hour"], [0.5, 0.95], ["p50", "p95"])
    ranked = v.join(merged.withColumnRenamed("hour", "_h"), F.col("hour").eqNullSafe(F.col("_h")))
    near = lambda p, q: (((F.count_if(F.col("speed_kmh") < F.col(q)) <= (p + 0.03) * F.count("speed_kmh"))
                          & (F.count_if(F.col("speed_kmh") <= F.col(q)) >= (p - 0.03) * F.count("speed_kmh"))))
    return ranked.groupBy("hour").agg(F.max("rows").alias("observations"), near(0.5, "p50").alias("p50_near"), near(0.95, "p95").alias("p95_near"))


def _bucketed(s, d, *feeds):
    """The refined feeds as tables bucketed by (vehicle_id, date)."""
    base = scratch_dir(s, "bucketed")
    db = "roadpulse_" + base.rsplit("-", 1)[-1]
    C.ensure_database(s, db, f"{base}/_db")
    return [s.table(C.write_bucketed(refined(s, d, feed), db, feed, base, buckets=8)) for feed in feeds]


plan("speed_by_weather_bucketed")(lambda s, d: V.speed_by_weather(*_bucketed(s, d, VEHICLE, WEATHER)))
plan("daily_kpi_bucketed")(lambda s, d: V.daily_kpi(*_bucketed(s, d, VEHICLE, WEATHER, EMERGENCY)))
plan("trips")(lambda s, d: X.trips(_v(s, d)))
plan("asof_weather")(lambda s, d: X.asof_weather(_v(s, d), _w(s, d)))


@plan("dead_letter")
def _dead_letter(s, d):
    """Vehicle wire records damaged in transit (a byte of line noise in front of the
    record on every 'error' step) are split off whole and undecoded; the rest decode."""
    rows = observations(events(s, d)).selectExpr(*feed_exprs(VEHICLE), "event_type = 'error' AS _damaged")
    wire = encode(rows, VEHICLE, keep=("_damaged",))
    wire = wire.select("key", F.when(F.col("_damaged"), F.concat(F.lit("~"), F.col("value")))
                       .otherwise(F.col("value")).alias("value"))
    _, bad = split_dead_letters(wire, VEHICLE)
    payload = F.substring("value", 2, 1 << 30)
    return bad.select("key", F.lit(VEHICLE).alias("feed"), F.substring("value", 1, 1).alias("noise"),
                      *[F.get_json_object(payload, f"$.{c}").cast(t).alias(c)
                        for c, t in (("id", "string"), ("vehicle_id", "string"), ("speed", "double"), ("make", "string"))])


def _corrected(s, d):
    """Vehicle records with copies that differ: every tenth step once more a second later with
    another speed, and every 500th record without its id."""
    r = raw(s, d, VEHICLE)
    step = F.substring("id", 5, 20).cast("long")
    late = r.filter(step % 10 == 0).withColumns({"timestamp": F.col("timestamp") + F.expr("INTERVAL 1 SECOND"), "speed": F.col("speed") + 1.0})
    return r.unionByName(late).withColumn("id", F.when(step % 500 != 1, F.col("id")))


plan("dedup_latest")(lambda s, d: P.dedup_latest(_corrected(s, d)))
# which copy survives is open here; which ids do is not
plan("dedup_id_copies")(lambda s, d: P.dedup(_corrected(s, d)).select("id"))


@plan("reject_counts")
def _reject_counts(s, d):
    """Rows each range rule rejects, per feed."""
    out = None
    for feed in (VEHICLE, GPS, WEATHER):
        part = P.reject_counts(raw(s, d, feed), feed)
        out = part if out is None else out.unionByName(part)
    return out


def _arrivals(s, d):
    """Vehicle records as a first load and two deltas. The first load holds ids twice, a day apart,
    records without an id or a time, and stale or missing records of the newest three dates;
    the first delta corrects and completes them, moves ids back a day and gives times; the
    second brings new ids on all dates."""
    r = raw(s, d, VEHICLE)
    recent = F.to_date("timestamp") >= F.date_sub(r.agg(F.max(F.to_date("timestamp"))).scalar(), 2)
    step = F.substring("id", 5, 20).cast("long")
    nameless = F.when(step % 500 != 1, F.col("id"))
    late, timeless, moved = recent & (step % 5 < 2), step % 97 == 0, step % 21 == 3
    first = (r.filter(~(recent & (step % 5 == 0)))
             .withColumns({"speed": F.when(recent & (step % 5 == 1), F.lit(1.0)).otherwise(F.col("speed")),
                           "timestamp": F.when(~timeless, F.col("timestamp")), "id": nameless}))
    again = r.filter((step % 7 == 3) & ~timeless & (step % 500 != 1)).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
    one = (r.filter((late | timeless | moved) & ((step % 500 != 1) | (step == 1)))
           .withColumns({"speed": F.col("speed") + F.when(moved, 2.0).otherwise(0.0), "id": nameless}))
    two = r.filter(step % 50 == 7).withColumn("id", F.concat(F.lit("new-"), step))
    return first.unionByName(again), one, two


@plan("incremental_refine")
def _incremental_refine(s, d):
    """A refined table after a first load and two deltas holds what a refine of all rows would, later
    deltas winning: one row per id whatever the date, and none left where an id moved from."""
    base = scratch_dir(s, "incremental")
    first, *deltas = _arrivals(s, d)
    S.write_refined(P.REFINERS[VEHICLE](P.dedup_latest(first), dedup_rows=False), VEHICLE, base)
    for delta in deltas:
        S.incremental_refine(delta, VEHICLE, base, id_buckets=8)
    return S.read_refined(s, VEHICLE, base).select("id", "vehicle_id", "timestamp", "date", "speed", "speed_kmh")


@plan("latest_by_partition")
def _latest_by_partition(s, d):
    """D1 from partitions: the newest 500 vehicle rows, read from the newest dates that hold as many."""
    base = scratch_dir(s, "newest")
    rows = S.write_refined(_v(s, d), VEHICLE, base)
    db = "roadpulse_" + base.rsplit("-", 1)[-1]
    C.ensure_database(s, db, f"{base}/_db")
    C.register_tables(s, db, base, (VEHICLE,), strict=True)
    C.register_dates(s, db, VEHICLE, base, rows.dates)
    return C.newest_rows(s, db, VEHICLE, 500).select(*D.VEHICLE_COLUMNS)


@plan("catalog_tables")
def _catalog_tables(s, d):
    """S7-S9 for all five feeds: refined tables written (concurrently), database and five
    external partitioned tables created, partitions repaired; rows per table and date count
    as the catalog reports them."""
    base = scratch_dir(s, "catalog-all")
    ev = events(s, d)
    written = run_concurrently({f: (lambda f=f: S.write_refined(P.REFINERS[f](derive_feed(ev, f)), f, base))
                                for f in FEEDS})
    for result in written.values():
        if isinstance(result, Exception):
            raise result
    db = "roadpulse_" + base.rsplit("-", 1)[-1]
    C.ensure_database(s, db, f"{base}/_db")
    C.register_tables(s, db, base, FEEDS, strict=True)
    parts = []
    for feed in FEEDS:
        C.repair_partitions(s, db, feed)
        parts.append(C.scan(s, db, feed).agg(F.count(F.lit(1)).alias("rows"),
                                               F.count_distinct("date").alias("dates"))
                     .select(F.lit(feed).alias("table"), "rows", "dates"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

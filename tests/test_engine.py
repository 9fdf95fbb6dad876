"""From messages to reports: batch equals stream, replays change nothing, the declarative form equals the fold."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from waymark import mapview, simulator
from waymark.operators import episodes, fold
from waymark.operators.enrich import enrich
from waymark.operators.landing import merge_writes
from waymark.plans import checks, dag, models, reports  # noqa: F401
from waymark.plans.dag import REGISTRY
from waymark.plans.warehouse import Warehouse
from waymark.queries import S, World
from waymark.sources import files, messages, reference, schemas
from waymark.sources.config import Settings, demo
from waymark.streaming import ingest

END = datetime(2026, 7, 26, 16, 0, tzinfo=timezone.utc)
SETTINGS = Settings()


@pytest.fixture(scope="module")
def day():
    return simulator.simulate(demo(), SETTINGS, hours=2.5, seed=42, corrupt=12, end=END)


def seeded(spark, root, run) -> Warehouse:
    w = Warehouse(spark, str(root))
    w.init()
    zones, routes = reference.zones(spark, demo()), reference.routes(spark, demo())
    for name, rows in (("zones", zones), ("routes", routes), ("vehicles", reference.vehicles(spark, demo())), ("route_schedule", reference.schedule(routes, zones)), ("trips", simulator.trip_frame(spark, run))):
        w.replace(f"ref.{name}", rows)
    return w


def consumed(spark, root, day, batches: int, repeat: int = 1) -> Warehouse:
    run, corrupt = day
    w = seeded(spark, root / "w", run)
    rows = simulator.message_frame(spark, run, corrupt).cache()
    for k in range(repeat):
        files.publish_in_order(rows, str(root / "m"), -(-rows.count() // batches))
        ingest.run(w, files.stream(spark, path=str(root / "m"), files_per_trigger=1), str(root / "c"), SETTINGS)
    return w


def found(w: Warehouse) -> list:
    names = ("detection_key", "severity", "trip_id", "ended_at", "duration_seconds", "magnitude", "lat", "lon")
    return sorted(map(tuple, ingest.episodes(w).select(*names).collect()), key=str)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory, day):
    return consumed(spark, tmp_path_factory.mktemp("one"), day, 1)


def test_simulation_is_repeatable_and_in_time(day):
    again, _ = simulator.simulate(demo(), SETTINGS, hours=2.5, seed=42, corrupt=12, end=END)
    assert again.pings == day[0].pings and len({p["ping_id"] for p in again.pings}) == len(again.pings)
    by_vehicle: dict = {}
    for p in again.pings:
        by_vehicle.setdefault(p["vehicle_id"], []).append(p["recorded_at"])
    assert all(times == sorted(times) for times in by_vehicle.values()) and len(by_vehicle) == 12
    quiet, _ = simulator.simulate(demo(), SETTINGS, hours=2.5, seed=42, incidents=False, end=END)
    assert not +quiet.incidents


def test_corrupt_messages_are_all_refused_and_the_rest_land(landed, day):
    assert landed.read("raw.pings").count() == len(day[0].pings) and landed.read("raw.pings_dead_letter").count() == 12
    row = landed.read("meta.ingest_batches").first()
    assert (row.rows_inserted, row.rows_duplicate, row.rows_rejected, row.status) == (len(day[0].pings), 0, 12, "committed")


def test_batches_of_any_size_give_the_same_episodes(spark, tmp_path, landed, day):
    assert found(consumed(spark, tmp_path, day, 5)) == found(landed)


def test_replay_lands_nothing_and_changes_nothing(spark, tmp_path, landed, day):
    w = consumed(spark, tmp_path, day, 1, repeat=2)
    assert w.read("raw.pings").count() == len(day[0].pings) and w.read("raw.pings_dead_letter").count() == 12 and found(w) == found(landed)
    last = w.read("meta.ingest_batches").orderBy(F.desc("batch_id")).first()
    assert (last.rows_inserted, last.rows_duplicate) == (0, len(day[0].pings))


def test_a_batch_run_again_comes_out_the_same(spark, tmp_path, day):
    run, corrupt = day
    w = seeded(spark, tmp_path, run)
    batch = simulator.message_frame(spark, run, corrupt)
    first = ingest.process(w, batch, 0, SETTINGS)
    before = found(w)
    again = ingest.process(w, batch, 0, SETTINGS)
    assert found(w) == before and first["rows_inserted"] == again["rows_inserted"] and w.read("stream.vehicle_state").count() == 12


def test_keyed_state_gives_the_same_writes(spark, tmp_path, landed):
    ref = {n: landed.read(f"ref.{n}") for n in ("zones", "trips", "routes", "route_schedule")}
    enriched = enrich(landed.read("raw.pings"), ref["zones"], ref["trips"], ref["routes"], ref["route_schedule"])
    columns = [*fold._COLUMNS]
    middle = enriched.agg(F.percentile_approx("recorded_at", 0.5)).first()[0]
    for part in (F.col("recorded_at") < middle, F.col("recorded_at") >= middle):
        enriched.where(part).select(*columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
    source = spark.readStream.schema(enriched.select(*columns).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "e"))
    query = ingest.stateful(source, fold.fences_of(ref["zones"]), SETTINGS).writeStream.format("memory").queryName("writes").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(180)
    pick = lambda df: sorted((r.detection_key, r.severity, str(r.ended_at), r.magnitude) for r in df.collect())
    assert pick(spark.table("writes")) == pick(landed.read("stream.detections"))


def test_warehouse_builds_and_its_tests_pass(spark, landed):
    ingest.publish_episodes(landed)
    assert dag.run(landed, SETTINGS.variables())["status"] == "success"
    core = [c for c in checks.CHECKS if c.model in ("int_ping_segments", "fct_trips", "fct_vehicle_hours", "agg_zone_activity")]
    assert [r for r in checks.run(landed, core)["results"] if r["status"] != "pass"] == []
    table = lambda n: landed.read(n if "." in n else REGISTRY.models[n].table)
    assert reports.alert_summary(table).count() >= 4 and reports.last_transform_run(table).first().models == 12 and reports.failing_tests(table, "x").count() == 0
    observed, split = table("int_ping_segments").agg(F.sum("observed_seconds"), F.sum(F.col("moving_seconds") + F.col("stopped_seconds"))).first()
    assert observed == split
    html = mapview.render(*[[r.asDict() for r in p.collect()] for p in (reports.map_zones(table), reports.map_routes(table), reports.map_tracks(table), reports.map_alerts(table), reports.map_cells(table))])
    assert html.count('class="zone"') == 8 and html.count('class="route"') == 4 and "http" not in html.replace("http://www.w3.org/2000/svg", "")


def test_the_declarative_form_equals_the_fold(spark):
    w = World(spark, "/root/testdata/sf0.001")
    kinds = ("gps_gap", "zone_visit", "geofence_breach", "route_deviation")
    writes = fold.fold(w.enriched, fold.fences_of(w.zones), S).where(F.col("detection_type").isin(*kinds)).withColumn("batch_id", F.lit(0))
    merged = merge_writes(writes, "batch_id", "write_seq")
    pick = lambda df: sorted((r.detection_key, r.severity, r.trip_id, str(r.ended_at), r.duration_seconds, round(r.lat, 9), r.magnitude) for r in df.collect())
    a, b = pick(merged), pick(episodes.all_declarative(w.enriched, w.zones, S))
    assert len(a) > 100 and [x[:5] for x in a] == [x[:5] for x in b]
    assert all((x[6] is None) == (y[6] is None) and (x[6] is None or abs(x[6] - y[6]) <= 0.0101) for x, y in zip(a, b))


def test_order_of_arrival_within_a_batch_does_not_matter(spark, landed):
    ref = {n: landed.read(f"ref.{n}") for n in ("zones", "trips", "routes", "route_schedule")}
    enriched = enrich(landed.read("raw.pings"), ref["zones"], ref["trips"], ref["routes"], ref["route_schedule"])
    keys = lambda df: sorted(r[0] for r in fold.fold(df, fold.fences_of(ref["zones"]), SETTINGS).where("detection_key IS NOT NULL").select("detection_key").collect())
    assert keys(enriched.orderBy(F.rand(1))) == keys(enriched)


def test_empty_tables_pass_through(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.init()
    row = ingest.process(w, spark.createDataFrame([], schemas.MESSAGES), 0, SETTINGS)
    assert row["messages_read"] == 0 and messages.rejected(messages.decoded(spark.createDataFrame([], schemas.MESSAGES))).count() == 0


def test_json_lines_and_pacing(spark, tmp_path, day):
    run, _ = day
    rows = simulator.message_frame(spark, run, []).selectExpr("CAST(value AS STRING) AS value")
    files.write_json_lines(rows, str(tmp_path / "l"))
    good = messages.valid(messages.decoded(files.read_json_lines(spark, str(tmp_path / "l"))))
    assert good.count() == len(run.pings)
    due = files.paced(spark, good, 100.0).agg(F.min("due_seconds"), F.max("due_seconds"), F.count_distinct("due_seconds")).first()
    assert due[0] == 0 and due[1] == pytest.approx((len(run.pings) - 1) / 100) and due[2] == len(run.pings)


@pytest.mark.parametrize("stop", [{"idle_timeout": 2.0}, {"max_messages": 1}])
def test_a_stream_stops_when_it_has_had_enough(spark, tmp_path, day, stop):
    run, corrupt = day
    w = seeded(spark, tmp_path / "w", run)
    files.publish_in_order(simulator.message_frame(spark, run, corrupt), str(tmp_path / "m"), 4000)
    query = ingest.run(w, files.stream(spark, path=str(tmp_path / "m")), str(tmp_path / "c"), SETTINGS, every="0 seconds", **stop)
    batches = w.read("meta.ingest_batches").count()
    assert not query.isActive and (batches >= 1 if "max_messages" in stop else w.read("raw.pings").count() == len(run.pings))


def test_states_are_read_from_the_last_batch_that_repeats_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "STATE_BATCHES", 2)
    w = Warehouse(spark, str(tmp_path))
    w.init()
    for k, rows in enumerate([[("a", "a0"), ("b", "b0")], [("a", "a1"), ("b", "b0")], [("a", "a2")], [("c", "c3"), ("a", "a2"), ("b", "b0")]]):
        w.write_batch("stream.vehicle_state", spark.createDataFrame(rows, "vehicle_id STRING, state STRING"), k)
    for batch, want in ((0, {}), (2, {"a": "a1", "b": "b0"}), (3, {"a": "a2", "b": "b0"}), (4, {"a": "a2", "b": "b0", "c": "c3"})):
        assert {r.vehicle_id: r.state for r in ingest.latest_states(w, batch).collect()} == want


def test_a_producer_may_look_at_its_messages_first(spark, day):
    run, corrupt = day
    rows = simulator.message_frame(spark, run, corrupt)
    assert files.refused(rows).count() == len(corrupt) == 12 and files.refused(simulator.message_frame(spark, run, [])).count() == 0


def test_a_topic_is_made_once_and_streams_from_the_start(spark, tmp_path):
    where = str(tmp_path / "topic")
    assert files.provision(spark, path=where) and not files.provision(spark, path=where)
    assert files.stream(spark, path=where).isStreaming

"""``python -m waymark COMMAND``: the engine from the command line.

Exit codes: 0 done, 1 something was refused, failed or found, 2 wrong use.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame

from waymark import mapview, simulator
from waymark.plans import checks, dag, models, reports  # noqa: F401 - declares the models
from waymark.plans.dag import REGISTRY
from waymark.plans.warehouse import Warehouse
from waymark.session import session, ship
from waymark.sources import files, reference
from waymark.sources.config import ConfigError, FleetConfig, Settings, demo, load
from waymark.streaming import ingest


class App:
    def __init__(self, args: argparse.Namespace):
        self.args = args
        self.spark = ship(session(**{"spark_sql_shuffle_partitions": str(args.shuffle_partitions)}))
        self.spark.sparkContext.setLogLevel("ERROR")
        self.settings = Settings.of_environment(os.environ)
        self.config: FleetConfig = load(args.config) if args.config else demo()
        self.warehouse = Warehouse(self.spark, args.root)
        dag.define_views(self.warehouse, self.settings.variables())
        self.messages = f"{args.root}/_messages"

    def table(self, name: str) -> DataFrame:
        return self.warehouse.read(name if "." in name else REGISTRY.models[name].table)

    def show(self, rows: DataFrame) -> int:
        rows.show(200, truncate=False)
        return 0

    def init_db(self) -> int:
        self.warehouse.init()
        files.provision(self.spark, path=self.messages, partitions=self.settings.partitions)
        return 0

    def seed(self) -> int:
        self.warehouse.init()
        zones, routes = reference.zones(self.spark, self.config), reference.routes(self.spark, self.config)
        for name, rows, key in (("zones", zones, "zone_id"), ("routes", routes, "route_id"), ("vehicles", reference.vehicles(self.spark, self.config), "vehicle_id")):
            self.warehouse.replace(f"ref.{name}", reference.upsert(self.warehouse.read(f"ref.{name}"), rows, key))
        self.warehouse.replace("ref.route_schedule", reference.schedule(self.warehouse.read("ref.routes"), self.warehouse.read("ref.zones")))
        return self.show(reference.counts({n: self.warehouse.read(f"ref.{n}") for n in ("zones", "routes", "vehicles", "trips", "route_schedule")}))

    def simulate(self) -> int:
        a = self.args
        run, corrupt = simulator.simulate(self.config, self.settings, hours=a.hours, seed=a.seed, incidents=a.incidents, corrupt=a.corrupt)
        print(f"{len(run.pings)} pings, {len(run.trips)} trips, {len(corrupt)} corrupt; incidents: {dict(run.incidents)}")
        if a.dry_run:
            return 0
        rows = simulator.message_frame(self.spark, run, corrupt, partitions=self.settings.partitions)
        if a.out:
            rows.selectExpr("CAST(value AS STRING) AS value").coalesce(1).write.mode("overwrite").text(a.out)
            return 0
        self.warehouse.replace("ref.trips", reference.upsert(self.warehouse.read("ref.trips"), simulator.trip_frame(self.spark, run), "trip_id"))
        files.publish_in_order(rows, self.messages, self.settings.consumer_batch_size, a.rate or None)
        return 0

    def consume(self) -> int:
        source = files.stream(self.spark, path=self.messages, files_per_trigger=self.args.files_per_batch)
        ingest.run(self.warehouse, source, f"{self.args.root}/_checkpoint", self.settings, available_now=not (self.args.idle_timeout or self.args.max_messages), idle_timeout=self.args.idle_timeout or None, max_messages=self.args.max_messages or None)
        ingest.publish_episodes(self.warehouse)
        rejected = self.warehouse.read("raw.pings_dead_letter").count()
        print(f"{self.warehouse.read('raw.pings').count()} pings landed, {rejected} messages rejected")
        return int(rejected > 0)

    def transform(self) -> int:
        done = dag.run(self.warehouse, self.settings.variables(), names=self.args.select, full_refresh=self.args.full_refresh)
        for m in done["models"]:
            print(f"{m['status']:8} {m['name']:20} {m['rows'] if m['rows'] is not None else '-':>8} {m['error'] or ''}")
        return int(done["status"] != "success")

    def test(self) -> int:
        done = checks.run(self.warehouse, names=self.args.select)
        for x in done["results"]:
            if x["status"] != "pass":
                print(f"{x['status']:5} {x['model']}.{x['column'] or ''} {x['test']} {x['failing'] if x['failing'] is not None else x['error']}")
        print(f"{done['passed']} passed, {done['failed']} failed, {done['errored']} errors")
        return int(done["failed"] + done["errored"] > 0)

    def pipeline(self) -> int:
        refused = self.consume()
        return self.transform() or self.test() or refused

    def alerts(self) -> int:
        a = self.args
        self.show(reports.alert_summary(self.table))
        return self.show(reports.alerts(self.table, limit=a.limit, detection_type=a.type, severity=a.severity, vehicle_id=a.vehicle, open_only=a.open))

    def trips(self) -> int:
        self.show(reports.trip_punctuality(self.table))
        return self.show(reports.trips(self.table, limit=self.args.limit, vehicle_id=self.args.vehicle))

    def vehicles(self) -> int:
        return self.show(reports.vehicles(self.table))

    def zones(self) -> int:
        return self.show(reports.zone_activity(self.table, days=self.args.days))

    def hotspots(self) -> int:
        return self.show(reports.hotspots(self.table, limit=self.args.limit))

    def map(self) -> int:
        hours, t = self.args.hours, self.table
        parts = (reports.map_zones(t), reports.map_routes(t), reports.map_tracks(t, hours=hours), reports.map_alerts(t, hours=hours), reports.map_cells(t))
        html = mapview.render(*[[r.asDict() for r in p.collect()] for p in parts])  # zones, routes, thinned tracks, late alerts and top cells
        Path(self.args.out).write_text(html, encoding="utf-8")
        print(f"{self.args.out}: {len(html)} characters")
        return 0

    def status(self) -> int:
        for name, n in reports.table_counts(self.warehouse, [m.table for m in REGISTRY.models.values()]):
            print(f"{name:28} {'-' if n is None else n}")
        for report in (reports.ingest_overview(self.table), reports.dead_letter_reasons(self.table), reports.recent_batches(self.table, self.args.limit), reports.last_transform_run(self.table), reports.last_test_run(self.table)):
            self.show(report)
        return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="waymark", description=__doc__)
    p.add_argument("--root", default="./warehouse", help="folder of the warehouse")
    p.add_argument("--config", help="fleet configuration (JSON); the demonstration fleet without it")
    p.add_argument("--shuffle-partitions", type=int, default=8)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple[str, dict]) -> None:
        one = sub.add_parser(name)
        for flag, how in options:
            one.add_argument(flag, **how)

    number = lambda n, kind=int: dict(type=kind, default=n)
    wait, pick = ("--idle-timeout", number(0.0, float)), ("--select", dict(nargs="*"))
    most = ("--max-messages", number(0))
    batch, fresh = ("--files-per-batch", number(1)), ("--full-refresh", dict(action="store_true"))
    command("init-db")
    command("seed")
    command("simulate", ("--hours", number(8.0, float)), ("--seed", dict(type=int)), ("--incidents", dict(action=argparse.BooleanOptionalAction, default=True)), ("--corrupt", number(0)), ("--rate", number(0.0, float)), ("--out", {}), ("--dry-run", dict(action="store_true")))
    command("consume", wait, most, batch)
    command("transform", pick, fresh)
    command("test", pick)
    command("pipeline", wait, most, batch, pick, fresh)
    command("alerts", ("--type", {}), ("--severity", {}), ("--vehicle", {}), ("--open", dict(action="store_true")), ("--limit", number(25)))
    command("trips", ("--vehicle", {}), ("--limit", number(20)))
    command("vehicles")
    command("zones", ("--days", number(7)))
    command("hotspots", ("--limit", number(12)))
    command("map", ("--out", dict(default="fleet-map.html")), ("--hours", number(6)))
    command("status", ("--limit", number(5)))
    return p


def main(argv: Sequence[str] | None = None) -> int:
    try:
        args = parser().parse_args(argv)
    except SystemExit as stop:
        return int(stop.code or 0)
    try:
        handler: Callable[[], int] = getattr(App(args), args.command.replace("-", "_"))
        return handler()
    except (ConfigError, dag.ModelError, checks.CheckError) as fault:
        print(f"error: {fault}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())

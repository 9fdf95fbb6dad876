"""A map of the fleet as one self-contained HTML file with an SVG in it."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from html import escape

from waymark.functions.earth import Position, haversine_m, mercator

WIDTH, HEIGHT, MARGIN = 1000, 760, 24
ZONE_FILL = {"depot": "#4f7cac", "customer": "#5b9a68", "restricted": "#b5443c", "congestion": "#c9a227"}
SEVERITY_FILL = {"critical": "#b5443c", "warning": "#d98324", "info": "#6b7280"}
ROUND_METRES = (50, 100, 200, 500, 1000, 2000, 5000, 10000, 20000, 50000, 100000)


@dataclass(frozen=True)
class Frame:
    """Web Mercator onto the page: one scale both ways, north up, content in the middle."""

    left: float
    top: float
    scale: float
    shift_x: float
    shift_y: float

    @staticmethod
    def around(places: Iterable[Position]) -> Frame:
        flat = [mercator(p) for p in places] or [mercator((0.0, 0.0))]
        xs, ys = [p[0] for p in flat], [p[1] for p in flat]
        wide, high = max(xs) - min(xs) or 1.0, max(ys) - min(ys) or 1.0
        scale = min((WIDTH - 2 * MARGIN) / wide, (HEIGHT - 2 * MARGIN) / high)
        return Frame(min(xs), max(ys), scale, (WIDTH - wide * scale) / 2, (HEIGHT - high * scale) / 2)

    def place(self, p: Position) -> tuple[float, float]:
        x, y = mercator(p)
        return round((x - self.left) * self.scale + self.shift_x, 2), round((self.top - y) * self.scale + self.shift_y, 2)

    def points(self, line: Iterable[Position]) -> str:
        return " ".join(f"{x},{y}" for x, y in map(self.place, line))


def scale_bar(frame: Frame, centre: Position) -> tuple[int, float]:
    """(metres, pixels) of the longest round length that is at most a quarter of the page."""
    step = 0.001
    x0, _ = frame.place(centre)
    x1, _ = frame.place((centre[0] + step, centre[1]))
    per_pixel = haversine_m(centre, (centre[0] + step, centre[1])) / max(1e-9, x1 - x0)
    metres = max((m for m in ROUND_METRES if m / per_pixel <= WIDTH / 4), default=ROUND_METRES[0])
    return metres, metres / per_pixel


def _line(text: str) -> list[Position]:
    """The positions of a GeoJSON line, or of a polygon's outer ring."""
    found = json.loads(text)
    return [tuple(p) for p in (found["coordinates"][0] if found["type"] == "Polygon" else found["coordinates"])]


def render(zones: list[dict], routes: list[dict], tracks: list[dict], alerts: list[dict], cells: list[dict], title: str = "Fleet map") -> str:
    rings = {z["zone_id"]: _line(z["boundary_geojson"]) for z in zones}
    lines = {r["route_id"]: _line(r["path_geojson"]) for r in routes}
    ways = [list(zip(t["lons"], t["lats"])) for t in tracks]
    everything = [p for group in (rings.values(), lines.values(), ways) for line in group for p in line] + [(a["lon"], a["lat"]) for a in alerts]
    frame, out = Frame.around(everything), []
    most = max((c["pings"] for c in cells), default=1)
    for c in cells:
        x, y = frame.place((c["mean_lon"], c["mean_lat"]))
        out.append(f'<circle class="cell" cx="{x}" cy="{y}" r="{4 + 14 * (c["pings"] / most) ** 0.5:.1f}"><title>{escape(str(c["cell_r8"]))}: {c["pings"]} pings</title></circle>')
    for z in zones:
        fill = ZONE_FILL.get(z["zone_kind"], "#888888")
        out.append(f'<polygon class="zone" points="{frame.points(rings[z["zone_id"]])}" fill="{fill}" stroke="{fill}"><title>{escape(z["name"])}: {z["visits"]} visits, {z["breaches"]} breaches</title></polygon>')
    for r in routes:
        out.append(f'<polyline class="route" points="{frame.points(lines[r["route_id"]])}"><title>{escape(r["name"])}, {r["length_km"]} km</title></polyline>')
    for t, way in zip(tracks, ways):
        out.append(f'<polyline class="track" points="{frame.points(way)}"><title>{escape(str(t["plate"]))} ({escape(str(t["vehicle_type"]))})</title></polyline>')
    for a in alerts:
        x, y = frame.place((a["lon"], a["lat"]))
        where = f' at {escape(a["zone_name"])}' if a.get("zone_name") else ""
        out.append(f'<circle class="alert" cx="{x}" cy="{y}" r="5" fill="{SEVERITY_FILL.get(a["severity"], "#888888")}"><title>{escape(a["detection_type"])} {escape(str(a["plate"] or a["vehicle_id"]))}{where}, {escape(str(a["started_at"]))}</title></circle>')
    if everything:
        metres, pixels = scale_bar(frame, everything[0])
        label = f"{metres // 1000} km" if metres >= 1000 else f"{metres} m"
        out.append(f'<g class="bar"><line x1="{MARGIN}" y1="{HEIGHT - 14}" x2="{MARGIN + pixels:.1f}" y2="{HEIGHT - 14}"/><text x="{MARGIN}" y="{HEIGHT - 20}">{label}</text></g>')
    style = "body{font:14px sans-serif;margin:16px}.cell{fill:#4f7cac;opacity:.18}.zone{fill-opacity:.25}.route{fill:none;stroke:#374151;stroke-width:2;stroke-dasharray:6 4}.track{fill:none;stroke:#2563eb;stroke-width:1;opacity:.6}.alert{stroke:#fff}.bar line{stroke:#111;stroke-width:3}"
    summary = f"{len(zones)} zones, {len(routes)} routes, {len(tracks)} vehicles, {len(alerts)} alerts"
    return f'<!doctype html><html lang="en"><head><meta charset="utf-8"><title>{escape(title)}</title><style>{style}</style></head><body><h1>{escape(title)}</h1><p>{summary}</p><svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {WIDTH} {HEIGHT}" width="{WIDTH}" height="{HEIGHT}">{"".join(out)}</svg></body></html>'

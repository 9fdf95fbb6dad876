from __future__ import annotations

import copy
import json

import pytest
from waymark.sources.config import DEMO, ConfigError, Settings, demo, load, parse


def broken(change) -> dict:
    data = copy.deepcopy(DEMO)
    change(data)
    return data


@pytest.mark.parametrize("change, said", [
    (lambda d: d.pop("zones"), "lacks 'zones'"), (lambda d: d.update(routes=[]), "routes must be a non-empty list"), (lambda d: d["zones"][0].pop("name"), "lacks 'name'"), (lambda d: d["zones"][0].update(zone_kind="park"), "must be one of"),
    (lambda d: d["zones"].append(d["zones"][0]), "duplicate zone"), (lambda d: d["zones"][0]["boundary"].pop(), "must be closed"), (lambda d: d["zones"][0].update(boundary=[[1, 1], [1, 1]]), "at least 4 positions"), (lambda d: d["zones"][0]["boundary"].__setitem__(1, [11.5, 104.8]), "latitude 104.8"),
    (lambda d: d["zones"][0]["boundary"].__setitem__(1, [200, 11.5]), "longitude 200"), (lambda d: d["zones"][0].update(max_dwell_minutes=0), "at least 1 or null"), (lambda d: d["routes"][0].update(start_zone_id="Z-NO"), "unknown zone"), (lambda d: d["routes"][0]["stop_zone_ids"].append("Z-NO"), "unknown zone"),
    (lambda d: d["routes"][0].update(path=[[1, 1]]), "at least 2 positions"), (lambda d: d["routes"][0].update(planned_duration_minutes=16), "leaves no time to drive"), (lambda d: d["routes"][0].update(service_minutes=-1), "at least 0"), (lambda d: d["routes"][0].update(planned_duration_minutes=True), "whole number"),
    (lambda d: d["routes"].append(d["routes"][0]), "duplicate route"), (lambda d: d["vehicles"][0].update(capacity_kg=0), "at least 1"), (lambda d: d["vehicles"][0].update(home_depot_id="Z-CUST-OLYMPIC"), "must be a depot"), (lambda d: d["vehicles"][0].update(vehicle_type="tram"), "must be one of"), (lambda d: d["vehicles"].append(d["vehicles"][0]), "duplicate vehicle"),
    (lambda d: [z.update(zone_kind="customer") for z in d["zones"]], "at least one zone must be a depot"), (lambda d: [r.update(start_zone_id="Z-DEPOT-N") for r in d["routes"]], "no route starts at"),
])
def test_each_fault_is_named(change, said):
    with pytest.raises(ConfigError, match=said):
        parse(broken(change))


def test_demo_and_files(tmp_path):
    whole = demo()
    assert (len(whole.zones), len(whole.routes), len(whole.vehicles)) == (8, 4, 12)
    (tmp_path / "fleet.json").write_text(json.dumps(DEMO))
    assert load(tmp_path / "fleet.json") == whole
    (tmp_path / "bad.json").write_text("{")
    for name, said in (("bad.json", "not valid JSON"), ("none.json", "no configuration")):
        with pytest.raises(ConfigError, match=said):
            load(tmp_path / name)


@pytest.mark.parametrize("changes", [{"idle_minutes": 0}, {"gps_gap_minutes": -1}, {"coarse_resolution": 9}, {"fine_resolution": 16}, {"consumer_batch_size": 0}])
def test_settings_are_checked(changes):
    with pytest.raises(ConfigError):
        Settings(**changes)
    assert Settings(idle_speed_kph=0).variables()["idle_speed_kph"] == 0


def test_settings_from_the_environment():
    found = Settings.of_environment({"WAYMARK_IDLE_MINUTES": "7.5", "WAYMARK_PARTITIONS": " 3 ", "WAYMARK_DELAY_MINUTES": "", "OTHER": "x"})
    assert found == Settings(idle_minutes=7.5, partitions=3)
    for name, text in (("IDLE_MINUTES", "soon"), ("PARTITIONS", "2.5"), ("DELAY_MINUTES", "0")):
        with pytest.raises(ConfigError):
            Settings.of_environment({f"WAYMARK_{name}": text})

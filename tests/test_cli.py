"""Every command of the command line, one after another, over one small warehouse."""

from __future__ import annotations

import json

import pytest
from waymark.__main__ import main


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    return str(tmp_path_factory.mktemp("cli"))


def command(root: str, *words: str) -> int:
    return main(["--root", root, "--shuffle-partitions", "4", *words])


def test_wrong_use_is_told_apart():
    assert main([]) == 2 and main(["fly"]) == 2 and main(["--help"]) == 0


def test_commands_in_the_order_of_a_day(root, tmp_path, capsys, monkeypatch):
    assert command(root, "init-db") == 0 and command(root, "seed") == 0
    assert "zones" in capsys.readouterr().out
    assert command(root, "simulate", "--hours", "1.2", "--seed", "5", "--dry-run") == 0
    assert command(root, "simulate", "--hours", "1.2", "--seed", "5", "--out", str(tmp_path / "lines")) == 0
    line = next((tmp_path / "lines").glob("part-*")).read_text().split("\n")[0]
    assert {"ping_id", "location"} <= set(json.loads(line))
    assert command(root, "simulate", "--hours", "1.2", "--seed", "5", "--corrupt", "9", "--rate", "100000") == 0
    assert command(root, "consume", "--max-messages", "400") == 1  # messages were refused, or more are to come
    assert command(root, "pipeline") == 1
    out = capsys.readouterr().out
    assert "9 messages rejected" in out and " 0 failed, 0 errors" in out and "failed   " not in out
    monkeypatch.setenv("WAYMARK_IDLE_MINUTES", "3")
    for words in (["transform", "--select", "dim_zone"], ["transform", "--full-refresh"], ["test", "--select", "dim_zone"], ["alerts", "--limit", "3", "--severity", "warning"], ["trips", "--limit", "3"], ["vehicles"], ["zones", "--days", "3000"], ["hotspots", "--limit", "3"], ["status"]):
        assert command(root, *words) == 0, words
    assert "raw.pings_dead_letter" in capsys.readouterr().out
    assert command(root, "map", "--out", str(tmp_path / "map.html")) == 0 and (tmp_path / "map.html").read_text().startswith("<!")


def test_faults_of_settings_configuration_and_models_end_with_two(root, tmp_path, monkeypatch):
    (tmp_path / "fleet.json").write_text("{}")
    assert main(["--root", root, "--config", str(tmp_path / "fleet.json"), "seed"]) == 2
    assert command(root, "transform", "--select", "nothing_such") == 2 and command(root, "test", "--select", "nothing_such") == 2
    monkeypatch.setenv("WAYMARK_PARTITIONS", "many")
    assert command(root, "status") == 2

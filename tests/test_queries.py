"""Every query against its SQL in another engine, on the smallest tables."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no shared test tables")


@pytest.fixture(scope="module")
def sql():
    import duckdb

    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for name in os.listdir(SF):
        c.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return c


def rows(names: list[str], found) -> list:
    plain = lambda v: "" if v is None else round(float(v), 6) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(plain(v) for v in r) for r in found), key=str)


def names_with_sql() -> list[str]:
    from waymark.queries import FLEET

    return [n for n, q in FLEET.items() if q.sql is not None]


@pytest.mark.parametrize("name", names_with_sql())
def test_query_equals_sql(spark, sql, name):
    from waymark.queries import FLEET

    q = FLEET[name]
    ours = q.run(spark, SF)
    cursor = sql.execute(q.oracle())
    assert [d[0] for d in cursor.description] == ours.columns
    assert rows(ours.columns, ours.collect()) == rows(ours.columns, cursor.fetchall())


def test_classifications_have_both_sides(spark):
    from waymark.queries import World

    s = World(spark, SF).ref("int_ping_segments")
    assert all(s.where(c).count() for c in ("is_moving", "NOT is_moving", "is_after_gap", "NOT is_after_gap"))


def test_entry_and_every_kind_of_episode(spark):
    import __spark_entry__ as e
    from waymark.queries import FLEET

    assert e.entry(spark).count() > 0
    kinds = {r.detection_type: r.episodes for r in FLEET["first_writes"].run(spark, SF).collect()}
    assert set(kinds) == {"idle", "delay", "gps_gap", "zone_visit", "geofence_breach", "route_deviation"} and min(kinds.values()) > 0

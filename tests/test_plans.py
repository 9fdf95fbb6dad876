"""The graph of models, the warehouse, data tests and reports."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from waymark.plans import checks, dag, models  # noqa: F401
from waymark.plans.checks import CHECKS, Check, CheckError, violations
from waymark.plans.dag import REGISTRY, Context, Model, ModelError, Registry, order, select
from waymark.plans.warehouse import Warehouse


def made(name: str, *refs: str, build=None, **options) -> Model:
    return Model(name, options.pop("folder", "marts"), build or (lambda ctx: ctx.source("x")), refs=refs, **options)


def graph(*items: Model) -> dict[str, Model]:
    return {m.name: m for m in items}


def test_order_is_alphabetical_among_what_is_ready():
    assert order(graph(made("c"), made("a", "c"), made("b", "c"))) == ["c", "a", "b"]
    assert select(graph(made("c"), made("a", "c"), made("b")), ["a"]) == ["c", "a"]


@pytest.mark.parametrize("items, said", [((made("a", "b"), made("b", "a")), "cycle"), ((made("a", "no"),), "not a model")])
def test_graphs_that_cannot_be_ordered(items, said):
    with pytest.raises(ModelError, match=said):
        order(graph(*items))


@pytest.mark.parametrize("options, said", [({"folder": "attic"}, "unknown folder"), ({"materialized": "cloud"}, "unknown materialization"), ({"materialized": "incremental"}, "unique_key"), ({"unique_key": "x"}, "only an incremental"), ({"materialized": "view", "sort_by": ("x",)}, "no layout")])
def test_models_are_checked(options, said):
    with pytest.raises(ModelError, match=said):
        made("m", **options).check()


def test_duplicates_unknown_names_and_variables():
    r = Registry()
    r.add(made("a"))
    with pytest.raises(ModelError, match="duplicate"):
        r.add(made("a"))
    with pytest.raises(ModelError, match="no model"):
        select(r.models, ["z"])
    with pytest.raises(ModelError, match="no variable"):
        Context({}, None, None).var("x")


def test_edges_of_the_project():
    refs = {n: set(m.refs) for n, m in REGISTRY.models.items()}
    assert len(refs) == 12 and refs["int_ping_segments"] == {"stg_pings"} and refs["fct_alerts"] == {"stg_detections", "dim_zone"} and refs["fct_trips"] == {"int_ping_segments", "fct_alerts", "dim_route"}
    assert refs["agg_daily_fleet"] == {"fct_vehicle_hours", "dim_vehicle", "fct_alerts", "fct_trips"} and refs["agg_zone_activity"] == {"fct_alerts", "dim_zone"}


def test_every_model_has_tests():
    assert {c.model for c in CHECKS} == set(REGISTRY.models) and len(CHECKS) > 170


def test_runs_skip_what_stands_on_a_failure_and_keep_the_old_table(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.init()
    w.replace("mart.bad", spark.range(3).toDF("id"))

    def fails(ctx):
        raise RuntimeError("no")

    r = Registry()
    for m in (made("good", build=lambda ctx: spark.range(2).toDF("id")), made("bad", build=fails), made("after", "bad"), made("later", "after"), made("seen", materialized="view", build=lambda ctx: spark.range(5).toDF("id"))):
        r.add(m)
    done = dag.run(w, {}, registry=r)
    assert {m["name"]: m["status"] for m in done["models"]} == {"good": "success", "bad": "failed", "after": "skipped", "later": "skipped", "seen": "success"} and done["status"] == "partial"
    assert w.read("mart.bad").count() == 3 and w.read("mart.seen").count() == 5 and w.read("meta.model_runs").count() == 5


def test_incremental_models_replace_by_key_and_full_refresh_starts_over(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.init()
    rows = {"now": [(1, "a"), (2, "a")]}
    r = Registry()
    r.add(made("grows", materialized="incremental", unique_key="id", build=lambda ctx: spark.createDataFrame(rows["now"], "id INT, v STRING")))
    dag.run(w, {}, registry=r)
    rows["now"] = [(2, "b"), (3, "b")]
    dag.run(w, {}, registry=r)
    assert sorted(map(tuple, w.read("mart.grows").collect())) == [(1, "a"), (2, "b"), (3, "b")]
    dag.run(w, {}, registry=r, full_refresh=True)
    assert sorted(map(tuple, w.read("mart.grows").collect())) == [(2, "b"), (3, "b")]


def test_writing_a_batch_again_replaces_it(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.init()
    frame = lambda *n: spark.createDataFrame([(str(x),) for x in n], "vehicle_id STRING").withColumn("state", F.lit("{}"))
    w.write_batch("stream.vehicle_state", frame(1, 2), 0)
    w.write_batch("stream.vehicle_state", frame(3), 1)
    w.write_batch("stream.vehicle_state", frame(3, 4), 1)
    assert sorted((r.vehicle_id, r.batch_id) for r in w.read("stream.vehicle_state").collect()) == [("1", 0), ("2", 0), ("3", 1), ("4", 1)]
    assert w.before("stream.vehicle_state", 1).count() == 2


def test_kinds_of_data_tests(spark):
    rows = spark.createDataFrame([(1, "a", None), (1, "b", 5), (None, "a", 5), (2, None, -1)], "id INT, kind STRING, n INT")
    parent = lambda name: spark.createDataFrame([(1,)], "id INT")
    count = lambda c: violations(c, rows, parent).first()[0]
    assert count(Check("m", "not_null", column="id")) == 1 and count(Check("m", "unique", column="id")) == 1
    assert count(Check("m", "accepted_values", column="kind", values=("a",))) == 1 and count(Check("m", "relationships", column="id", to="p", field="id")) == 1
    assert count(Check("m", "unique_combination", columns=("id", "n"))) == 0 and count(Check("m", "assert_expression", expression="n > 0")) == 2
    assert violations(Check("m", "unique", column="id"), rows.limit(0)).first()[0] == 0


@pytest.mark.parametrize("wrong", [dict(kind="magic"), dict(kind="not_null"), dict(kind="accepted_values", column="c"), dict(kind="relationships", column="c", to="m"), dict(kind="unique_combination", columns=("a",)), dict(kind="assert_expression", expression=" ")])
def test_wrong_declarations(wrong):
    with pytest.raises(CheckError):
        Check("m", **wrong)


def test_a_test_that_cannot_run_is_an_error_not_a_failure(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.init()
    done = checks.run(w, [Check("dim_zone", "not_null", column="name")])
    assert (done["failed"], done["errored"]) == (0, 1)


def test_readers_of_the_version_before_still_find_it(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    for n in (1, 2, 3):
        w.replace("mart.t", spark.range(n))
        if n == 1:
            first = w.read("mart.t")
        if n == 2:
            second = w.read("mart.t")
            assert first.count() == 1
    assert second.count() == 2 and w.read("mart.t").count() == 3 and Warehouse(spark, str(tmp_path)).read("mart.t").count() == 3
    assert len(w._pointers("mart.t")) == 2


def test_an_increment_rewrites_only_the_partitions_of_its_rows(spark, tmp_path):
    r, rows = Registry(), {"now": [(1, "a", 1, 0), (1, "b", 1, 0), (2, "a", 2, 0)]}
    r.add(made("parts", materialized="incremental", unique_key=("id", "kind"), partition_by="day", build=lambda ctx: spark.createDataFrame(rows["now"], "id INT, kind STRING, day INT, n INT")))
    w = Warehouse(spark, str(tmp_path))
    w.init()
    dag.run(w, {}, registry=r)
    rows["now"] = [(1, "b", 1, 9), (3, "a", 3, 9)]
    before = {x.input_file for x in w.read("mart.parts").where("day = 2").selectExpr("input_file_name() AS input_file").collect()}
    assert dag.run(w, {}, registry=r)["status"] == "success"
    assert sorted(map(tuple, w.read("mart.parts").select("id", "kind", "day", "n").collect())) == [(1, "a", 1, 0), (1, "b", 1, 9), (2, "a", 2, 0), (3, "a", 3, 9)]
    assert before == {x.input_file for x in w.read("mart.parts").where("day = 2").selectExpr("input_file_name() AS input_file").collect()}


def test_a_view_is_there_for_another_process(spark, tmp_path):
    r = Registry()
    r.add(made("seen", materialized="view", build=lambda ctx: spark.range(5)))
    w = Warehouse(spark, str(tmp_path))
    w.init()
    dag.run(w, {}, registry=r)
    again = Warehouse(spark, str(tmp_path))
    with pytest.raises(LookupError):
        again.read("mart.seen")
    dag.define_views(again, {}, r.models)
    assert again.exists("mart.seen") and again.read("mart.seen").count() == 5


def test_rules_of_one_row_are_counted_together_and_a_broken_one_alone(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path))
    w.init()
    r = Registry()
    r.add(made("t", folder="marts", build=lambda ctx: spark.createDataFrame([(1, "a"), (None, "b")], "id INT, kind STRING")))
    monkeypatch.setattr(checks, "REGISTRY", r)
    dag.run(w, {}, registry=r)
    own = [Check("t", "not_null", column="id"), Check("t", "accepted_values", column="kind", values=("a", "b")), Check("t", "unique", column="id")]
    assert [(x["status"], x["failing"]) for x in checks.run(w, own)["results"]] == [("fail", 1), ("pass", 0), ("pass", 0)]
    bad = [*own, Check("t", "assert_expression", expression="nowhere > 1")]
    assert [x["status"] for x in checks.run(w, bad)["results"]] == ["fail", "pass", "pass", "error"]

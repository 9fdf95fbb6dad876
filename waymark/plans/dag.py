"""Models, their graph, and how they are built.

References are found by running a model's function against a context that only
records them, so the graph cannot disagree with the code.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.landing import delete_insert
from waymark.plans.warehouse import Warehouse
from waymark.sources import schemas

LAYER = {"staging": "stg", "intermediate": "stg", "marts": "mart"}
KINDS = ("table", "view", "incremental")


class ModelError(ValueError):
    """A model, or a graph of models, that cannot be built."""


@dataclass(frozen=True)
class Model:
    name: str
    folder: str
    build: Callable[[Context], DataFrame]
    materialized: str = "table"
    #: One column, or several.
    unique_key: str | tuple[str, ...] | None = None
    #: A column that a key's row never changes: an incremental run rewrites only the partitions that its rows fall in.
    partition_by: str | None = None
    sort_by: tuple[str, ...] = ()
    refs: tuple[str, ...] = ()

    @property
    def key(self) -> tuple[str, ...]:
        return (self.unique_key,) if isinstance(self.unique_key, str) else tuple(self.unique_key or ())

    @property
    def table(self) -> str:
        return f"{LAYER[self.folder]}.{self.name}"

    def check(self) -> Model:
        if self.folder not in LAYER:
            raise ModelError(f"{self.name}: unknown folder {self.folder!r}")
        if self.materialized not in KINDS:
            raise ModelError(f"{self.name}: unknown materialization {self.materialized!r}")
        if self.materialized == "incremental" and not self.unique_key:
            raise ModelError(f"{self.name}: an incremental model needs a unique_key")
        if self.materialized != "incremental" and self.unique_key:
            raise ModelError(f"{self.name}: only an incremental model has a unique_key")
        if self.materialized == "view" and self.sort_by:
            raise ModelError(f"{self.name}: a view has no layout to sort")
        return self


class Registry:
    def __init__(self) -> None:
        self.models: dict[str, Model] = {}

    def model(self, folder: str, **options):
        """A decorator that declares a model under the function's name."""

        def declare(build: Callable[[Context], DataFrame]):
            self.add(Model(build.__name__, folder, build, refs=references(build), **options))
            return build

        return declare

    def add(self, one: Model) -> None:
        if one.name in self.models:
            raise ModelError(f"duplicate model {one.name!r}")
        self.models[one.name] = one.check()


def references(build: Callable) -> tuple[str, ...]:
    """The literal names that a model's code passes to ``ref``."""
    import ast
    import inspect
    import textwrap

    tree = ast.parse(textwrap.dedent(inspect.getsource(build)))
    calls = [n for n in ast.walk(tree) if isinstance(n, ast.Call) and isinstance(n.func, ast.Attribute) and n.func.attr == "ref"]
    for call in calls:
        if len(call.args) != 1 or not isinstance(call.args[0], ast.Constant):
            raise ModelError(f"{build.__name__}: ref needs the name itself")
    return tuple(sorted({call.args[0].value for call in calls}))


REGISTRY = Registry()
model = REGISTRY.model


def order(models: Mapping[str, Model]) -> list[str]:
    """Names with every model after those it refers to; of several that could come next, the alphabetically first."""
    for m in models.values():
        for r in m.refs:
            if r not in models:
                raise ModelError(f"{m.name} refers to {r!r}, which is not a model")
    waiting, out = {n: set(m.refs) for n, m in models.items()}, []
    while waiting:
        ready = min((n for n, needs in waiting.items() if not needs), default=None)
        if ready is None:
            raise ModelError(f"the models refer to each other in a cycle: {', '.join(sorted(waiting))}")
        out.append(ready)
        del waiting[ready]
        for needs in waiting.values():
            needs.discard(ready)
    return out


def select(models: Mapping[str, Model], names: Iterable[str] | None) -> list[str]:
    """The named models and all that they are built from, in order; all if there are no names."""
    whole = order(models)
    if not names:
        return whole
    wanted, open_ = set(), list(names)
    for n in open_:
        if n not in models:
            raise ModelError(f"there is no model {n!r}")
    while open_:
        n = open_.pop()
        if n not in wanted:
            wanted.add(n)
            open_ += models[n].refs
    return [n for n in whole if n in wanted]


class Context:
    """What a model sees while it is built."""

    def __init__(self, variables: Mapping[str, object], source: Callable[[str], DataFrame], ref: Callable[[str], DataFrame], this: DataFrame | None = None):
        self._variables, self.source, self.ref, self._this = variables, source, ref, this

    def var(self, name: str):
        if name not in self._variables:
            raise ModelError(f"there is no variable {name!r}")
        return self._variables[name]

    def is_incremental(self) -> bool:
        return self._this is not None

    def this(self) -> DataFrame:
        if self._this is None:
            raise ModelError("there is no table to add to")
        return self._this


def in_memory(sources: Mapping[str, DataFrame], variables: Mapping[str, object], models: Mapping[str, Model] | None = None) -> Callable[[str], DataFrame]:
    """``ref`` over sources that are only plans: a model becomes part of the query that uses it."""
    models, made = models or REGISTRY.models, {}

    def ref(name: str) -> DataFrame:
        if name not in made:
            made[name] = models[name].build(Context(variables, lambda t: sources[t], ref))
        return made[name]

    return ref


def _now() -> datetime:
    return datetime.now(timezone.utc)


def run(warehouse: Warehouse, variables: Mapping[str, object], *, names: Iterable[str] | None = None, full_refresh: bool = False, registry: Registry | None = None) -> dict:
    """Build models into the warehouse; {"run_id", "status", "models": [...]}.

    A model whose reference failed or was skipped is skipped.  Each is switched in
    on its own, so a failure leaves its old table in place.
    """
    models = (registry or REGISTRY).models
    spark: SparkSession = warehouse.spark
    define_views(warehouse, variables, models)
    run_id, states, log = uuid.uuid4().hex, {}, []
    for name in select(models, names):
        m, began = models[name], _now()
        bad = [r for r in m.refs if states.get(r) in ("failed", "skipped")]
        rows, error = None, None
        if bad:
            states[name], error = "skipped", f"depends on {', '.join(bad)}"
        else:
            try:
                rows = _materialise(warehouse, m, models, variables, full_refresh)
                states[name] = "success"
            except Exception as fault:  # noqa: BLE001 - any fault of a model is that model's result
                states[name], error = "failed", str(fault)[:2000]
        log.append((run_id, name, m.folder, m.materialized, states[name], rows, began, _now(), error))
    warehouse.append("meta.model_runs", spark.createDataFrame(log, schemas.MODEL_RUNS).coalesce(1))
    good = sum(s == "success" for s in states.values())
    status = "success" if good == len(states) else "failed" if not good else "partial"
    return {"run_id": run_id, "status": status, "models": [dict(zip(("name", "status", "rows", "error"), (x[1], x[4], x[5], x[8]))) for x in log]}


def define_views(warehouse: Warehouse, variables: Mapping[str, object], models: Mapping[str, Model] | None = None) -> None:
    """Let the warehouse make recorded views of ``models`` again."""
    known = models or REGISTRY.models

    def define(table: str) -> DataFrame:
        for m in known.values():
            if m.table == table:
                return m.build(Context(variables, warehouse.read, lambda n: warehouse.read(known[n].table)))
        raise LookupError(f"no model defines the view {table!r}")

    warehouse.definitions = define


def _materialise(warehouse: Warehouse, m: Model, models: Mapping[str, Model], variables: Mapping[str, object], full_refresh: bool) -> int:
    grows = m.materialized == "incremental" and not full_refresh and warehouse.exists(m.table)
    old = warehouse.read(m.table) if grows else None
    context = Context(variables, warehouse.read, lambda n: warehouse.read(models[n].table), old)
    rows = m.build(context)
    if m.materialized == "view":
        warehouse.view(m.table, rows)
    elif grows and m.partition_by:
        # Only the partitions of the stage's rows are read, and written.
        touched = rows.select(m.partition_by).distinct()
        beside = old.join(touched.withColumnRenamed(m.partition_by, "_part"), F.col(m.partition_by).eqNullSafe(F.col("_part")), "left_semi")
        warehouse.replace_partitions(m.table, delete_insert(beside, rows, *m.key), m.partition_by, m.sort_by)
    elif grows:
        warehouse.replace(m.table, delete_insert(old, rows, *m.key), sort_by=m.sort_by)
    else:
        warehouse.replace(m.table, rows, (m.partition_by,) if m.partition_by else (), m.sort_by)
    return warehouse.read(m.table).count()

"""A set of models that refer to each other, built in order.

Each model is a function of the models it refers to, with a materialisation
(view, table) and tests. A failing test fails its model; what refers to a failed model,
directly or not, is skipped, the rest is built.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from .pipeline import TestsFailed, gate, materialize_model


@dataclass(frozen=True)
class Model:
    """``build`` gets the models of ``refs`` by name; ``tests`` are functions from the model to its failing rows."""
    build: Callable[..., DataFrame]
    refs: Sequence[str] = ()
    how: str = "view"
    tests: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    severity: str = "error"


@dataclass(frozen=True)
class Built:
    status: str                       # "built", "failed" or "skipped"
    data: DataFrame | None = None
    why: str = ""


def build_all(spark: SparkSession, models: Mapping[str, Model], root: str, prefix: str = "") -> dict[str, Built]:
    """Build the models so that each follows what it refers to; tables lie in ``root``, views are named ``prefix`` + name."""
    for name, m in models.items():
        if strange := [r for r in m.refs if r not in models]:
            raise ValueError(f"{name} refers to {strange}, which aren't models")
    out: dict[str, Built] = {}
    for name in TopologicalSorter({n: m.refs for n, m in models.items()}).static_order():
        m = models[name]
        if lost := [r for r in m.refs if out[r].status != "built"]:
            out[name] = Built("skipped", why=", ".join(lost))
            continue
        data = m.build(**{r: out[r].data for r in m.refs})
        data = materialize_model(spark, data, prefix + name, m.how, path=f"{root.rstrip('/')}/{name}" if m.how != "view" else None)
        try:
            gate({t: failing(data) for t, failing in m.tests.items()}, m.severity)
        except TestsFailed as exc:
            out[name] = Built("failed", data, str(exc))
        else:
            out[name] = Built("built", data)
    return out

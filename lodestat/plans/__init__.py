"""Plans bind the operators to tables; ``load`` registers all of them."""

import importlib

MODULES = ("sources", "cleaning", "joins", "aggregates", "windows", "scalars", "statistics", "evaluation", "series", "graph", "streams", "vectors", "learning")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"lodestat.plans.{name}")

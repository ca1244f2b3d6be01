"""All registered queries, grouped by module."""

from importlib import import_module
from pkgutil import iter_modules

from trajtable.plans.catalog.base import ORACLES, QUERIES


def _load() -> None:
    for module in iter_modules(__path__):
        import_module(f"{__name__}.{module.name}")


def queries():
    _load()
    return dict(QUERIES)


def oracles():
    _load()
    return dict(ORACLES)

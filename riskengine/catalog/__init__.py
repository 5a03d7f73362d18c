"""Named queries. Importing the modules fills the registry."""

import importlib

MODULES = ["tables", "checks", "profile", "features", "scores", "models", "streams", "watch", "storage"]


def load_all():
    from riskengine.catalog.registry import ORACLES, QUERIES

    for name in MODULES:
        importlib.import_module(f"riskengine.catalog.{name}")
    return QUERIES, ORACLES

"""The registered queries, one module per operator family."""

from __future__ import annotations

import importlib
import os

from pricepanel.catalog import base

MODULES = [
    "sources",
    "profile",
    "align",
    "impute",
    "normalise",
    "features",
    "correlate",
    "regress",
    "validate",
    "quality",
    "matrix",
]


def load():
    here = os.path.dirname(__file__)
    for name in MODULES:
        if os.path.exists(os.path.join(here, f"{name}.py")):
            importlib.import_module(f"pricepanel.catalog.{name}")
    return dict(base.QUERIES), dict(base.ORACLES)

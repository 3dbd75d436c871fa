"""Importing this module registers every query of the subpackage."""

from __future__ import annotations

from pricepanel.llm import corpus_queries, filter_queries, training_queries  # noqa: F401
from pricepanel.llm.registry import ORACLES, QUERIES


def load():
    return dict(QUERIES), dict(ORACLES)

"""All registered queries; importing a family module registers its entries."""

from __future__ import annotations

import importlib

from .base import REGISTRY, Entry

FAMILIES = [
    "operational", "verified", "questions", "spatial", "series", "planning", "search",
    "enrich", "dashboard", "quality", "changes", "sources",
]


def load_all() -> dict[str, Entry]:
    for family in FAMILIES:
        importlib.import_module(f"{__name__}.{family}")
    return REGISTRY

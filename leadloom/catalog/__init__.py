"""Named queries over the star-schema tables."""

from __future__ import annotations

import importlib

FAMILIES = ("columns_q", "metrics_q", "leads_q", "models_q")


def load_all() -> None:
    for family in FAMILIES:
        importlib.import_module(f"{__name__}.{family}")

"""Query registry of the analytics part: name -> callable and name -> DuckDB SQL."""

from __future__ import annotations

from . import linking, reporting, texts, upkeep

FLAGSHIP = "category_share"
QUERIES: dict = reporting.QUERIES | linking.QUERIES | texts.QUERIES | upkeep.QUERIES
ORACLES: dict = reporting.ORACLES | linking.ORACLES | texts.ORACLES | upkeep.ORACLES

"""Settings of the matching stages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column

from .functions.fuzzy import Scorer


@dataclass(frozen=True)
class MatchConfig:
    """radius_m: location matches; nearby_m: what reports call near; dedup_m: one site; high_kv: high voltage from above.

    conflict: who writes when several sites hit one row: "last" in the order of stages, then of rows, or "best", the
    first stage.  key_mode: "normalized", or "raw" for targets whose names are their keys.  scorer: "difflib", "indel" or
    "edits", or a `functions.fuzzy.Scorer` of one's own.
    key_fn: name -> key, STR-15 unless given.  fuzzy_threshold: least score at which names count as alike.
    """

    radius_m: float = 3000.0
    nearby_m: float = 10_000.0
    dedup_m: float = 300.0
    fuzzy_threshold: float = 65.0
    use_fuzzy: bool = True
    high_kv: float = 57.0
    conflict: str = "last"
    key_mode: str = "normalized"
    scorer: str | Scorer = "difflib"
    key_fn: Callable[[Column], Column] | None = None

    def override(self, **given) -> MatchConfig:
        """Settings that are given and not None replace these (PRJ-17)."""
        return replace(self, **{k: v for k, v in given.items() if v is not None})


#: Thresholds of the three linking stages and of the library itself.
LIBRARY = MatchConfig(fuzzy_threshold=70.0)
LINK_SITES = MatchConfig(fuzzy_threshold=65.0)
ENRICH_NAMES = MatchConfig(fuzzy_threshold=85.0)
FILL_COORDINATES = MatchConfig(fuzzy_threshold=65.0, key_mode="raw")

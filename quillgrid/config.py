"""Knobs with their defaults and floors. Executors never read the environment."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

TRUE_WORDS = frozenset({"1", "true", "yes", "on"})


@dataclass(frozen=True)
class Settings:
    """Defaults of the discovery, processing and analysis steps; ``floors`` are the least allowed values."""

    articles_per_source: int = 15
    min_words: int = 300
    map_multiplier: int = 20
    map_minimum: int = 80
    score_threshold: int = 4
    date_bonus: int = 4
    feed_bonus: int = 6
    category_pages: int = 3
    category_min_rows: int = 10
    links_per_page: int = 250
    cooldown_hours: int = 6
    failures_to_trip: int = 3
    sitemap_months: int = 4
    refresh_cadence_hours: int = 24
    refresh_window_days: int = 0
    summary_chars: int = 220
    summary_sentences: int = 4
    compat: bool = True

    @classmethod
    def floors(cls) -> dict[str, int]:
        return {f.name: 0 if f.name == "refresh_window_days" else 1 for f in fields(cls) if f.type == "int"}

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> Settings:
        """Coerce text values: whole numbers with a floor, yes/no words; anything else keeps the default."""
        made, floors = cls(), cls.floors()
        for name, text in values.items():
            key = name.lower()
            if key in floors:
                try:
                    made = replace(made, **{key: max(floors[key], int(str(text).strip()))})
                except ValueError:
                    continue
            elif key == "compat":
                made = replace(made, compat=str(text).strip().lower() in TRUE_WORDS)
        return made


def override(pairs: str | None, name: str, default: int) -> int:
    """First ``key=value`` of a comma list whose key equals the name when only letters and digits count, if its value is digits."""
    plain = lambda x: "".join(c for c in x.lower() if c.isascii() and c.isalnum())
    for pair in (pairs or "").split(","):
        key, eq, value = pair.partition("=")
        if eq and plain(key) == plain(name) and value.strip().isdigit():
            return int(value.strip())
    return default


def scrape_timeout_ms(preprint_host: bool, attempt: int) -> int:
    return 120_000 + 60_000 * preprint_host + 30_000 * attempt


def map_limit(limit: int, settings: Settings = Settings()) -> int:
    return max(limit * settings.map_multiplier, settings.map_minimum)

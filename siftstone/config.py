"""Settings with typed defaults; an environment variable of the given name overrides one."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields

# Environment variable and default of each setting.
_SETTINGS = {
    "candidate_images": ("SCRAPE_CANDIDATE_IMAGES", 100),
    "target_min": ("SCRAPE_TARGET_IMAGES_MIN", 12),
    "target_max": ("SCRAPE_TARGET_IMAGES_MAX", 15),
    "min_to_advance": ("SCRAPE_MIN_IMAGES", 12),
    "skip_days": ("SCRAPE_SKIP_DAYS", 15),
    "min_width": ("SCRAPE_MIN_WIDTH", 600),
    "min_height": ("SCRAPE_MIN_HEIGHT", 600),
    "min_aspect": ("SCRAPE_MIN_ASPECT", 0.4),
    "max_aspect": ("SCRAPE_MAX_ASPECT", 2.5),
    "score_min": ("SCRAPE_AESTHETIC_MIN", 6.0),
    "similarity": ("SCRAPE_CLIP_DEDUP", 0.89),
    "hash_distance": ("SCRAPE_PHASH_DEDUP", 8),
    "dynamic_queries": ("SCRAPE_DYNAMIC_QUERIES", True),
    "use_browser": ("SCRAPE_USE_BB_BROWSER", False),
    "first_tab_quota": ("KP_ALL_TAB_QUOTA", 30),
    "tab_quota": ("KP_OTHER_TAB_QUOTA", 10),
    "tabs_cap": ("KP_TOTAL_CAP", 200),
    "image_page_cap": ("GOOGLE_IMAGES_MAX", 50),
    "site_cap": ("OFFICIAL_SITE_MAX", 50),
}


def truthy(text: str) -> bool:
    return text.lower() in ("true", "1", "yes")


def _read(name: str):
    env, default = _SETTINGS[name]
    raw = os.environ.get(env)
    if raw is None:
        return default
    return truthy(raw) if isinstance(default, bool) else type(default)(raw)


def _setting(name: str):
    return field(default_factory=lambda: _read(name))


@dataclass(frozen=True)
class Config:
    candidate_images: int = _setting("candidate_images")
    target_min: int = _setting("target_min")
    target_max: int = _setting("target_max")
    min_to_advance: int = _setting("min_to_advance")
    skip_days: int = _setting("skip_days")
    min_width: int = _setting("min_width")
    min_height: int = _setting("min_height")
    min_aspect: float = _setting("min_aspect")
    max_aspect: float = _setting("max_aspect")
    score_min: float = _setting("score_min")
    similarity: float = _setting("similarity")
    hash_distance: int = _setting("hash_distance")
    dynamic_queries: bool = _setting("dynamic_queries")
    use_browser: bool = _setting("use_browser")
    first_tab_quota: int = _setting("first_tab_quota")
    tab_quota: int = _setting("tab_quota")
    tabs_cap: int = _setting("tabs_cap")
    image_page_cap: int = _setting("image_page_cap")
    site_cap: int = _setting("site_cap")


assert {f.name for f in fields(Config)} == set(_SETTINGS)

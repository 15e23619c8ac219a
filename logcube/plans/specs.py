"""The growth reports as data.  Twelve near-identical scripts collapse into
seven specs: download v1/v2, install v1/v2, open v1/v2 and the open hybrid.
"""

from __future__ import annotations

from dataclasses import dataclass

CAT = "<category>"  # placeholder in grouping sets for the spec's category column


@dataclass(frozen=True)
class GrowthSpec:
    name: str
    kinds: tuple[str, ...]
    title_rule: str  # "log" | "catalog" | "conditional"
    category: str  # "fsk_cid" | "fsk_catalog"
    sets: tuple[tuple[str, ...], ...]  # None-free; CAT stands for the category column
    with_source: bool = False

    @property
    def keys(self) -> tuple[str, ...]:
        src = ("source",) if self.with_source else ()
        return ("package_id", "title", *src, "site", self.category)

    @property
    def key_names(self) -> tuple[str, ...]:
        src = ("appSource",) if self.with_source else ()
        return ("appId", "appName", *src, "channelName", "typeName")

    @property
    def grouping_sets(self) -> list[list[str]]:
        return [[self.category if c == CAT else c for c in s] for s in self.sets]


DETAIL4 = ("package_id", "title", "site", CAT)
DETAIL5 = ("package_id", "title", "source", "site", CAT)

# Grouping sets of the report families.
SETS_V1_4 = (DETAIL4, ())
SETS_V2_4 = (DETAIL4, ("site", CAT), ("site",), (CAT,), ())
SETS_V1_5 = (DETAIL5, ())
SETS_V2_5 = (
    DETAIL5,
    ("source", "site", CAT),
    ("source", "site"),
    ("source", CAT),
    ("site", CAT),
    ("source",),
    ("site",),
    (CAT,),
    (),
)

DOWNLOAD = ("download_fin",)
INSTALL = ("install_fin",)
OPEN = ("app_open", "game_open")

DOWNLOAD_V1 = GrowthSpec("download_v1", DOWNLOAD, "log", "fsk_cid", SETS_V1_4)
DOWNLOAD_V2 = GrowthSpec("download_v2", DOWNLOAD, "catalog", "fsk_catalog", SETS_V2_4)
INSTALL_V1 = GrowthSpec("install_v1", INSTALL, "log", "fsk_cid", SETS_V1_4)
INSTALL_V2 = GrowthSpec("install_v2", INSTALL, "catalog", "fsk_catalog", SETS_V2_4)
OPEN_V1 = GrowthSpec("open_v1", OPEN, "log", "fsk_cid", SETS_V1_5, with_source=True)
OPEN_V2 = GrowthSpec("open_v2", OPEN, "conditional", "fsk_catalog", SETS_V2_5, with_source=True)
OPEN_HYBRID = GrowthSpec("open_hybrid", OPEN, "conditional", "fsk_cid", SETS_V1_5, with_source=True)

SPECS = {s.name: s for s in (DOWNLOAD_V1, DOWNLOAD_V2, INSTALL_V1, INSTALL_V2, OPEN_V1, OPEN_V2, OPEN_HYBRID)}

"""Yearly person panels from overlapping employment and benefit episodes, on Spark."""

from careerpanel.functions.people import People, by_person
from careerpanel.plans.incremental import PanelStore
from careerpanel.plans.pipeline import prepare_panel, run_panel, store_panel
from careerpanel.sources.ingest import read_episodes, write_panel
from careerpanel.sources.lookups import default_lookups, read_lookups
from careerpanel.sources.store import EpisodeStore, open_bucketed, save_bucketed

__all__ = [
    "EpisodeStore",
    "PanelStore",
    "People",
    "by_person",
    "default_lookups",
    "open_bucketed",
    "prepare_panel",
    "read_episodes",
    "read_lookups",
    "run_panel",
    "save_bucketed",
    "store_panel",
    "write_panel",
]

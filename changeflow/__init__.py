"""Keyed tables kept current from snapshots and change rows, on plain Spark."""

from changeflow.operators.guarded import guarded_changes, replay_guarded
from changeflow.operators.history import history
from changeflow.operators.latest import latest, latest_row_changes
from changeflow.operators.merge import apply_changes, merge, row_changes
from changeflow.operators.replay import net_changes, replay
from changeflow.session import build_session
from changeflow.sources.partitioned import PartitionedTable
from changeflow.sources.table import KeyedTable
from changeflow.streaming.ingest import BronzeIngest, DistinctIngest, SilverIngest, follow

__all__ = [
    "BronzeIngest",
    "DistinctIngest",
    "KeyedTable",
    "PartitionedTable",
    "SilverIngest",
    "apply_changes",
    "build_session",
    "follow",
    "guarded_changes",
    "history",
    "latest",
    "latest_row_changes",
    "merge",
    "net_changes",
    "replay",
    "replay_guarded",
    "row_changes",
]

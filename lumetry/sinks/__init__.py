from .bucketed import merge_bucketed, merged, write_bucketed
from .commits import Staged, committed, read_committed
from .deltas import (
    closing_sums,
    delta_grains,
    read_closing_sums,
    read_delta_grains,
    read_marks,
    read_readings,
    stage_grains,
)
from .jdbc import jdbc_options, jdbc_revisions
from .lookups import looked_up
from .tables import (
    compact,
    console,
    create_if_missing,
    document_store,
    documents,
    folded,
    memory,
    nowhere,
    parquet,
    read_revisions,
    revisions,
    stage_revisions,
)

__all__ = [
    "Staged",
    "closing_sums",
    "committed",
    "compact",
    "console",
    "create_if_missing",
    "delta_grains",
    "document_store",
    "documents",
    "folded",
    "jdbc_options",
    "jdbc_revisions",
    "looked_up",
    "memory",
    "merge_bucketed",
    "merged",
    "nowhere",
    "parquet",
    "read_closing_sums",
    "read_committed",
    "read_delta_grains",
    "read_marks",
    "read_readings",
    "read_revisions",
    "revisions",
    "stage_grains",
    "stage_revisions",
    "write_bucketed",
]

from tidemark.plans.keyed_log import KeyedLog
from tidemark.plans.runner import LoadResult, export, extract, open_table, prepare, run_load
from tidemark.plans.session import cluster_settings, shuffle_partitions
from tidemark.plans.spec import Changes, Full, Incremental, LoadSpec, Scd1, Scd2, load_connection, load_spec
from tidemark.plans.versioned import VersionedTable
from tidemark.plans.workspace import scratch_path, shared_folder, staged, staging

__all__ = [
    "Changes",
    "Full",
    "Incremental",
    "KeyedLog",
    "LoadResult",
    "LoadSpec",
    "Scd1",
    "Scd2",
    "VersionedTable",
    "cluster_settings",
    "export",
    "extract",
    "load_connection",
    "load_spec",
    "open_table",
    "prepare",
    "run_load",
    "scratch_path",
    "shared_folder",
    "shuffle_partitions",
    "staged",
    "staging",
]

from roostline.sinks.manifests import ConcurrentLoadError, Manifest, VersionedTable
from roostline.sinks.tables import NAMESPACES, Candidate, Warehouse, namespace
from roostline.sinks.upsert import RepeatedKeyError

__all__ = [
    "NAMESPACES",
    "Candidate",
    "ConcurrentLoadError",
    "Manifest",
    "RepeatedKeyError",
    "VersionedTable",
    "Warehouse",
    "namespace",
]

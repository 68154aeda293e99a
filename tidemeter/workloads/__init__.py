"""Every operator as a query over the given tables, with its SQL counterpart where there is one."""

from tidemeter.workloads import collecting, functions, ingest, layers, merging, quality, realtime, serving, wide
from tidemeter.workloads.registry import REGISTRY

__all__ = [
    "REGISTRY",
    "collecting",
    "functions",
    "ingest",
    "layers",
    "merging",
    "quality",
    "realtime",
    "serving",
    "wide",
]

"""Every operator as a named query over the given tables, with equivalent SQL."""

from siltstone.workloads import (  # noqa: F401
    changes,
    checking,
    copying,
    enrichment,
    governing,
    layers,
    streams,
)
from siltstone.workloads.registry import ORACLE, QUERIES  # noqa: F401

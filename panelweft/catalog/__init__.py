"""Registered queries: name -> (function of session and folder, SQL or None).

Every query reads whole tables. Conditions on nation or customer keys hand
out roles, so that each branch of an operator meets rows: a nation known to
one source only, a region without a weight, a value changed on purpose. They
never shrink the work, and both engines apply the same ones.
"""

from __future__ import annotations

from panelweft.catalog import (
    allocation,
    comparison,
    filling,
    gates,
    series,
    sources,
    spatial,
    world,
    writing,
)

MODULES = (sources, series, allocation, filling, spatial, gates, comparison, writing, world)


def all_queries():
    found = {}
    for module in MODULES:
        for name, entry in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} registered twice")
            found[name] = entry
    return found

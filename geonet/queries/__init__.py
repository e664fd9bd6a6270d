"""Registered queries: name -> (Spark callable, oracle text or None)."""

from __future__ import annotations

from geonet.queries import attributes, coverage, lines, network, pipelines, sources

GROUPS = (attributes, sources, lines, coverage, network, pipelines)


def registry() -> dict:
    found: dict = {}
    for group in GROUPS:
        for name, entry in group.QUERIES.items():
            if name in found:
                raise ValueError(f"query registered twice: {name}")
            found[name] = entry
    return found

"""Registered queries (one per operator) and the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("objects", "pixels", "tiles", "volumes", "ledger", "geometry", "registration", "block_objects")


def all_queries() -> dict:
    merged = {}
    for name in _MODULES:
        merged.update(import_module(f"voxelweave.queries.{name}").query.queries)
    return merged


def all_oracles() -> dict:
    merged = {}
    for name in _MODULES:
        merged.update(import_module(f"voxelweave.queries.{name}").query.oracles)
    return merged

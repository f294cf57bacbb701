"""Registration helper shared by the query modules."""

from __future__ import annotations


class Registry:
    def __init__(self) -> None:
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def register(fn):
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = sql
            return fn

        return register

"""How plan modules register queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable


class Plans:
    """Named queries (spark, sf_dir) -> DataFrame and, where SQL can say it, the same in DuckDB SQL."""

    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def put(f: Callable) -> Callable:
            self.queries[name] = f
            if sql:
                self.oracle[name] = sql
            return f

        return put

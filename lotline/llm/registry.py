"""What ``__spark_entry__`` registers of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from lotline.llm import oracles, queries as own

QUERIES: dict[str, Callable] = {
    name: function for name, function in vars(own).items() if name.startswith("op")
}
ORACLE_SQL: dict[str, str] = oracles.SQL

"""Every query of the library's own operators, by name, with its SQL."""

from __future__ import annotations

from quillgraph.plans import evidence, linkage, links, names, records, registry, retrieval, rows, scalars, tables, texts  # noqa: F401  (importing registers)


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLE_SQL)

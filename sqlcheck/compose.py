"""Assemble self-contained DuckDB statements from named CTE bodies."""

from __future__ import annotations

from sqlcheck.binding import BINDING_CTES

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def with_ctes(body: str, *extra: dict[str, str]) -> str:
    """Prefix ``body`` with every binding CTE plus the given extra CTE maps.

    CTE order is preserved; later ones may reference earlier ones.  DuckDB
    only evaluates CTEs a statement actually references.
    """
    ctes: dict[str, str] = dict(BINDING_CTES)
    for e in extra:
        ctes.update(e)
    parts = [f"{name} AS ({sql}\n)" for name, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def register_driver_views(con, sf_dir: str) -> None:
    for t in DRIVER_TABLES:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")

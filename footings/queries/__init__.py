"""Demonstration queries over the shared tables, grouped like the operators."""

from importlib import import_module

MODULES = ("scalar", "household", "sources", "filters", "joins", "aggregates",
           "windows", "ranking", "gates", "documents", "warehouse", "provenance")


def load_all() -> None:
    """Import every query module so that it registers its queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")

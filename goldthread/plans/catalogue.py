"""Loads every module that registers queries."""

from importlib import import_module

MODULES = ("scalar", "identity", "tables", "relational", "survivorship", "landing", "lifecycle")


def load() -> None:
    for name in MODULES:
        import_module(f"goldthread.plans.{name}")


load()

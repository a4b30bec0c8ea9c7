"""Registered queries of the core and the SQL each is checked against."""

from importlib import import_module

MODULES = ("references", "master", "text", "quota", "generate", "quality", "files")


def load_all() -> None:
    for m in MODULES:
        import_module(f"quotaloom.plans.{m}")

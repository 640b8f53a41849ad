"""Registered queries over a warehouse folder, each with an independent SQL equivalent."""

from __future__ import annotations

from importlib import import_module

MODULES = ("calendar", "sales", "hierarchy", "matching", "promotions", "allocation")


def all_checks():
    from festivo.checks.registry import CHECKS

    for module in MODULES:
        import_module(f"festivo.checks.{module}")
    return CHECKS

"""Imports every module that registers queries."""

from __future__ import annotations

import importlib

MODULES = (
    "tidemark.plans.catalogue_documents",
    "tidemark.plans.catalogue_normalized",
    "tidemark.plans.catalogue_published",
    "tidemark.plans.catalogue_screening",
    "tidemark.plans.catalogue_data",
    "tidemark.plans.catalogue_streams",
)


def load() -> None:
    for name in MODULES:
        importlib.import_module(name)

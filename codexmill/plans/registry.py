"""The query modules of the core."""

from __future__ import annotations

from types import ModuleType

from codexmill.plans import documents, general, graph, ingest, publishing, rules


def modules() -> list[ModuleType]:
    return [general, graph, documents, publishing, ingest, rules]

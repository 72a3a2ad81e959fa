"""All registered queries by name."""

from __future__ import annotations

from talkatlas.plans import documents, models, similarity, tables, texts
from talkatlas.plans.common import Query


def all_queries() -> dict[str, Query]:
    merged: dict[str, Query] = {}
    for module in (tables, texts, similarity, documents, models):
        merged.update(module.QUERIES)
    return merged

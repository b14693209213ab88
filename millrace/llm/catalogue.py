"""All queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

from millrace.llm.common import QUERIES, SQL

for _module in ("mixing", "sharding", "quality", "chat", "secret_owners", "toxicity", "jaccard", "decontaminate", "suffixes", "lines", "divergence", "negatives", "kernel_quality"):
    importlib.import_module(f"millrace.llm.{_module}")

__all__ = ["QUERIES", "SQL"]

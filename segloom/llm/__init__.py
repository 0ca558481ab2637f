"""Operators of a training-data pipeline, one module each; `load()` gives their queries."""

import importlib

MODULES = ("pii", "fingerprints", "substrings", "pieces", "embeddings", "chat", "neardup", "toxicity", "mixing", "lines", "periodic", "whitening", "pages")


def load() -> tuple[dict, dict]:
    """All registered queries and their SQL."""
    from segloom.llm.common import ORACLE, QUERIES

    for module in MODULES:
        importlib.import_module(f"segloom.llm.{module}")
    return dict(QUERIES), dict(ORACLE)

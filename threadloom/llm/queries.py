"""Queries of the operators; importing a module registers its own."""

from threadloom.llm import chat_windows, codes, decontaminate, disclosure, lines, neighbours, packing, periodic, repair, similar, toxicity, url_rules, warc  # noqa: F401
from threadloom.llm.base import CATALOG


def queries():
    return {name: entry.run for name, entry in CATALOG.items()}


def oracles():
    return {name: entry.sql for name, entry in CATALOG.items() if entry.sql is not None}

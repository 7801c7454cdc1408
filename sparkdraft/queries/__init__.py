"""The operators applied to the benchmark tables, each with a SQL oracle.

Domain mapping: an order stands for a game or build, a customer for a draft, a part
name or brand for a card, a part key for an arena id, a conversation turn for a turn.
"""

from sparkdraft.queries import (association, cleaning, joins, merging, quality, registry,
                                sources, tables, textfiles)
from sparkdraft.queries.registry import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries", "association", "cleaning", "joins", "merging",
           "quality", "registry", "sources", "tables", "textfiles"]

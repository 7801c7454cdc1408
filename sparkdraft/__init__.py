"""Spark-native modelling and analytics of draft, match and replay data.

Sub-packages
------------
``functions``  column expressions: keys, tolerant cleaning, probabilities
``sources``    wide text sources, header layouts, the committed table store
``operators``  reusable DataFrame operators: reshape, merge, checks, ordering
``plans``      the jobs: normalized tables, integrity report, association, factors
``streaming``  incremental ingest on Structured Streaming
``queries``    the operators applied to the benchmark tables, with SQL oracles
"""

from sparkdraft.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]

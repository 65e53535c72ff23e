"""Registered queries, each beside the SQL that recomputes it.

Importing the group modules fills the registry; ``__spark_entry__`` lists it.
"""

from quizlake.catalog.registry import ORACLES, QUERIES
# the order of the lists: cheap groups first, trained models last
from quizlake.catalog import tables, extraction, questions, scalars, corpora, reports, streams  # noqa: F401
from quizlake.catalog import options, models  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]

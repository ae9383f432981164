"""All registered queries. Importing the modules fills the registry."""

from faultloom.plans import (  # noqa: F401
    q_agreement,
    q_corpus,
    q_intake,
    q_labels,
    q_links,
    q_stream,
    q_weekly,
)
from faultloom.plans.registry import QUERIES

__all__ = ["QUERIES"]

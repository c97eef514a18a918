"""The operators bound to the test tables, each with an equivalent SQL text."""

from featuremart.catalogue import fixed, mobile, storage, training  # noqa: F401  register their queries
from featuremart.catalogue.registry import ORACLES, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)

"""Queries over the given tables, one per capability, each with its SQL counterpart."""

from dimlathe.catalogue import lookups, merges, scalars, shaping, storage, views  # noqa: F401
from dimlathe.catalogue.registry import CATALOGUE, Tables  # noqa: F401

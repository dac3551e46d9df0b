"""Readers, writers and adapters."""

from vigilo.sources.readers import (
    PRESENCE_SCHEMA,
    PERIODS_SCHEMA,
    ENTITY_DIM_SCHEMA,
    PRESENCE_FEATURES_SCHEMA,
    PERIOD_FEATURES_SCHEMA,
    read_presence,
    read_periods,
    read_entity_dim,
    read_features,
    write_features,
    require_inputs,
    MissingInputError,
)
from vigilo.sources import adapters

__all__ = [
    "PRESENCE_SCHEMA", "PERIODS_SCHEMA", "ENTITY_DIM_SCHEMA", "PRESENCE_FEATURES_SCHEMA",
    "PERIOD_FEATURES_SCHEMA", "read_presence", "read_periods", "read_entity_dim", "read_features",
    "write_features", "require_inputs", "MissingInputError", "adapters",
]

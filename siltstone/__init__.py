"""siltstone: layered (raw, bronze, silver, gold) processing of paged JSON feeds on Spark."""

from siltstone.config import RunConfig

__all__ = ["RunConfig"]

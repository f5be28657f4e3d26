"""Connected components of a link table."""

from evalspark.operators.graph import components

__all__ = ["components"]

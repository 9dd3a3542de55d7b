"""Column expressions and fixed value tables."""

from kredo.functions import codes, scalars  # noqa: F401

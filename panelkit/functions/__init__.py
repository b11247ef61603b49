"""Column expressions and schema helpers."""

from panelkit.functions import columns, constants, scalars  # noqa: F401

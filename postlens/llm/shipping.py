"""The package for Python workers, as the rest of the library sends it."""

from ..shipping import ship_code

__all__ = ["ship_code"]

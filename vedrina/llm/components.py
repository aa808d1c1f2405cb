"""Connected components, as the library finds them for any links."""

from vedrina.operators.components import connected_components

__all__ = ["connected_components"]

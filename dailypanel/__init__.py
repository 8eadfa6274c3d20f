"""Panel analytics on event readings, as lazy Spark plans."""

from dailypanel.catalog import Catalog, PanelColumn

__all__ = ["Catalog", "PanelColumn"]

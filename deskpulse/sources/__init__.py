"""Input tables.

``Tables`` holds the fifteen inputs the reports read.  ``load_tables``
derives them from the driver's parquet files (``fixtures``); a deployment
builds ``Tables`` from its own catalog with ``Tables.from_catalog``.
"""

from deskpulse.sources.tables import Tables, load_tables

__all__ = ["Tables", "load_tables"]

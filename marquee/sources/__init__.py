"""Sources and sinks: raw CSV scan, testdata tables and adapter, versioned store, CSV export."""

from marquee.sources.raw import read_raw_csv, apply_null_tokens
from marquee.sources.testdata import read_table, catalog_from_orders
from marquee.sources.store import CatalogStore, MissingInputError
from marquee.sources.export import write_csv, export_for_bi, title_countries

__all__ = [
    "read_raw_csv", "apply_null_tokens", "read_table", "catalog_from_orders",
    "CatalogStore", "MissingInputError", "write_csv", "export_for_bi", "title_countries",
]

"""Sources: raw JSON-document tables, their parsed form and the flattened ``__t`` tables."""

from shelfmark.sources.catalogue import Catalogue

__all__ = ["Catalogue"]

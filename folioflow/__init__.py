"""folioflow: DataFrame-first analytics for catalogs of long documents."""

__version__ = "0.1.0"

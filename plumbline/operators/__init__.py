"""The checks. Importing this package registers the built-in ones."""

from plumbline.operators import duplicates, outliers, references, row_rules, value_sets

__all__ = ["duplicates", "outliers", "references", "row_rules", "value_sets"]

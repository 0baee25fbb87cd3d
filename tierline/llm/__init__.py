"""Operators for preparing training data (the numbered operators of the
README). Nothing else in the library imports this subpackage."""

"""Operators for preparing training data at scale. Optional: nothing else in the library imports this subpackage."""

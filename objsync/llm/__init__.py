"""Operators for large-scale training-data work, with their queries in ``queries``."""

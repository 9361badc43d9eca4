"""Batch operators, one module per domain."""

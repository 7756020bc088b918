"""Incremental landing of source files as tables."""

"""Reading trees of small files, text tables and JSON; writing result tables."""

"""Readers with header contracts, row lineage and versioned table folders."""

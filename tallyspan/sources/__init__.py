"""Inputs: delimited files, the stored fact table, star-schema tables."""

"""Outputs besides the stored table."""

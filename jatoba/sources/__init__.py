"""Readers for landed API pages and layer tables."""

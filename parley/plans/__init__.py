"""Whole jobs: load, transform, write."""

"""Whole steps: read, transform, write."""

"""Readers, writers and the dataset layout."""

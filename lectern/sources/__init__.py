"""Readers: feeds, URL lists, manifests, article files and tables."""

"""Readers: revision histories, title lists, dump manifests and stage tables."""

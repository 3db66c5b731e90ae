"""Readers and writers of landing files, registries, manifests and protected tables."""

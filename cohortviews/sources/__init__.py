"""Readers of raw files, manifests, labels and artefacts, and the writers."""

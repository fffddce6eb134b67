"""Readers and writers: XML exports, JSON lines, manifests, checkpoints."""

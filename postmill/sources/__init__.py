"""Readers, selections, checkpoints, loading and export."""

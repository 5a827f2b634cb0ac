"""Registered queries, test views and checkpoints."""

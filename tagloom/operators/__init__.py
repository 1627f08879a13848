"""Operators over cells, logs and ids."""

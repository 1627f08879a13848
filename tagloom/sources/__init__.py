"""Readers and writers of the datasets around the engine."""

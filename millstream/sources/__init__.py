"""Readers, writers and progress markers."""

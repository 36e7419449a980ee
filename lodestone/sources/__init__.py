"""Readers of files and streams, and writers of tables."""

"""Readers, external tables and writers."""

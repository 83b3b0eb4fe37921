"""Readers, writers, versioned tables and scratch storage."""

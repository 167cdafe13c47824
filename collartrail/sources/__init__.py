"""Readers, scanners and writers."""

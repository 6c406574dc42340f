"""Readers and writers of the file formats, with declared schemas."""

"""Readers and writers of the file formats around association tables."""

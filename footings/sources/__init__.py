"""Readers and writers: datasets, files, word boxes, worksheet cells."""

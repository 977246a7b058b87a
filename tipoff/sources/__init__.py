"""Readers and writers: landing files, bronze tables, legacy extracts, the given tables."""

"""Readers and writers: files, the versioned keyed table, landed web pages."""

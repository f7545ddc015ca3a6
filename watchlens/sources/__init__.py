"""Readers and writers: messages, dimension files, tables, dead letters."""

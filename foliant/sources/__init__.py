"""Readers and writers: text trees, archives, feeds, cells tables, exports."""

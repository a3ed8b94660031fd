"""Sinks: CSV / JSON / text files, report tables, insert-select into tables."""

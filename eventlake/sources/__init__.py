"""Readers and writers of record files, calendars, feeds and CSV extracts."""

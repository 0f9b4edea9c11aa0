"""Readers and writers: logs, files, remote pages."""

"""Readers: text files, headers, observations, archives and file lists."""

"""Readers and writers: landing files, format descriptors, the catalog, dictionaries, sinks."""

"""Readers and writers. Schemas are explicit; paths may be local or on any Hadoop file system."""

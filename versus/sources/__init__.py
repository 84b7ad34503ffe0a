"""Readers and writers: text triples, labels, word vectors, sweep logs, tables."""

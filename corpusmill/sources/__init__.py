"""Readers and writers: text lines, JSON arrays, JSON lines, samples, tokenizers."""

"""Readers and writers of the text formats at the edges."""

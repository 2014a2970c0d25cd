"""Readers, writers and listings of minute and collector directories."""

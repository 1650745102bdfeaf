"""Readers and writers of agent traces."""

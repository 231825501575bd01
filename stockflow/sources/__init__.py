"""Readers, writers and the fixture adapters."""

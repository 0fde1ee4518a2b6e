"""Readers: files, station folders, messages, nested payloads, and the test-table adapters."""

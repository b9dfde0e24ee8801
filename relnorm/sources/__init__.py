"""Readers: archive manifests and entries, loose text, JSON/CSV tables,
JSON dictionaries, static providers and path selection."""

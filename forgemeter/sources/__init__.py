"""Declared tables, landed payloads and stored datasets."""

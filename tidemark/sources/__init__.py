"""Readers, vendor payload layouts, writers and manifests."""

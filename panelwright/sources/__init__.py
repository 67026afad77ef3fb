"""Scans, manifests, code lists and sinks."""

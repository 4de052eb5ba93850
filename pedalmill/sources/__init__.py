"""Readers, file manifests and sinks."""

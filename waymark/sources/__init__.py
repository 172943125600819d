"""Readers, writers and parsers of stored inputs."""

"""Destinations: files, object stores, message queues, tables, and the registry that picks one from a URL."""

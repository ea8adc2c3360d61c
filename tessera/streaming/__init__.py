"""Streaming forms of the change watcher."""

"""Composed jobs: Silver builds, warehouse refresh, and the registered query catalogue."""

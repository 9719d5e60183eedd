"""Composed jobs: inventory build, dispatch, page scan, joined results."""

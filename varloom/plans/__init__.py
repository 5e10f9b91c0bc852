"""Composed jobs: preparing a source, publishing a data set, the query catalogue."""

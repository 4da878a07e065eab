"""Pipelines: a source stream applied to versioned tables, with restart and removal."""

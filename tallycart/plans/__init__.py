"""Whole jobs: cubes, the published document, the end-to-end run."""

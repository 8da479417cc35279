"""Whole jobs: from landing files to reports, one function per step."""

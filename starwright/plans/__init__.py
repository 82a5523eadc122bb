"""Whole builds: sources in, star schema or lookup tables out."""

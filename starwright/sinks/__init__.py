"""File and table writes."""

"""DataFrame-to-DataFrame building blocks: dimensions, matching, intervals, merges."""

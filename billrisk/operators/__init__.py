"""Building blocks: each takes and returns DataFrames."""

"""Table operations. Each takes and returns DataFrames unless its text says it writes."""

"""Table scans, parameterised SQL and table writes."""

"""Column-level functions: lenient parsing, personal-data masking, rule expressions."""

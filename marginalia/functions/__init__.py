"""Column functions: text normal forms, matches with offsets, small scorers."""

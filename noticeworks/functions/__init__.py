"""Column functions: every function takes Columns and returns a Column."""

"""Independent SQL statements for the same results, used to check the operators."""

"""Column expressions: keys, exact money arithmetic, calendar fields and labels."""

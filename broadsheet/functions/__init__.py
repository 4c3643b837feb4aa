"""Column helpers. Everything here is a Column -> Column expression."""

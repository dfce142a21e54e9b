"""Column -> Column business rules."""

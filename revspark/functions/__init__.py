"""Column -> Column functions: business rules and exact money arithmetic."""

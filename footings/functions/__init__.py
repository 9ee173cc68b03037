"""Column expressions: cleaning, fiscal years, text, household arithmetic, checks."""

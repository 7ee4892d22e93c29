"""Column expressions and the functions offered to SQL users."""

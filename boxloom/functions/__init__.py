"""Column expressions; each works on plain columns and inside `transform` over nested arrays."""

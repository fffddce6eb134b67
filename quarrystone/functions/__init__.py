"""Column expressions and Arrow functions on text, dates and markup."""

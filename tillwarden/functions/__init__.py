"""Column expressions: rules, money, rates, calendar."""

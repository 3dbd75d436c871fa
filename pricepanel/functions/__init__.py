"""Column expressions: statistics, calendar features, text helpers."""

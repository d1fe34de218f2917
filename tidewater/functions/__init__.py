"""Column expressions: time zones and epochs, event contracts, VARIANT rules, names and types."""

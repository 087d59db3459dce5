"""DataFrame to DataFrame operators, usable with ``.transform`` on tables and on streams."""

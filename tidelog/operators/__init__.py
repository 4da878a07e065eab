"""DataFrame to DataFrame: change records, apply, routing, value formats."""

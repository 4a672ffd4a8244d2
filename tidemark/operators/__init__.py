"""DataFrame operators: cleaning, nulls, duplicates, keys, look-ups, history."""

"""DataFrame operators: cleaning, ordered windows, interval joins, statistics."""

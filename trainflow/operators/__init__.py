"""DataFrame operators: quality reports, counts, encodings, splits, metrics, gate, history."""

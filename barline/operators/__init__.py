"""DataFrame operators: series windows, merges, history, batches and checks."""

"""DataFrame-in, DataFrame-out operators: catalog, inference, loading, table lifecycle."""

"""DataFrame to DataFrame operators over cells and docs."""

"""DataFrame operators: comparison, points, batch export."""

"""DataFrame to DataFrame operators. None of them writes."""

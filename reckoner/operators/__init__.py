"""DataFrame-to-DataFrame operators: enrich, aggregate, rank, tokens, filters."""

"""DataFrame operators: publish/parse lines, typed views, aggregates, top-k, trend."""

"""Search, scoring, aggregation, suggestion and hit shaping over an index."""

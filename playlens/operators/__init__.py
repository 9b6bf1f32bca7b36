"""DataFrame -> DataFrame operators (joins, aggregations, rankings, ML)."""

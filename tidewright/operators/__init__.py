"""DataFrame operators: joins, aggregates, time windows, row shaping and data quality."""

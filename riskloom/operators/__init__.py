"""DataFrame operators: joins, ordered and windowed computations, statistics, preparation."""

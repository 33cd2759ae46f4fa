"""Table operators: quality, numbering, key lookup, behaviour, profiling."""

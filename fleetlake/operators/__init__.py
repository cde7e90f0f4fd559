"""DataFrame-in, DataFrame-out operators of the fleet model."""

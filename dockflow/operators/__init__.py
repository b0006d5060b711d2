"""DataFrame operators of the flow engine."""

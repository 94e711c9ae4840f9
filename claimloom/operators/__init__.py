"""DataFrame in, DataFrame out: the operators of the claims pipelines."""

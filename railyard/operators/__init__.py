"""DataFrame in, DataFrame out: the library's relational operators."""

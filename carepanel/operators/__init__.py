"""DataFrame in, DataFrame out. Each module covers one clinical job."""

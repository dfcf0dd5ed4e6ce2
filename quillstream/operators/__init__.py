"""DataFrame operators: profiling, frequencies, features, metrics, predictions."""

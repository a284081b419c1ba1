"""Training, evaluation and application of failure models with MLlib."""

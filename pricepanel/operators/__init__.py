"""Panel operators: profiling, alignment, imputation, features, models, validation."""

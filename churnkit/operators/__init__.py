"""Table operators: profiling, assembly, features, models, evaluation, monitoring."""

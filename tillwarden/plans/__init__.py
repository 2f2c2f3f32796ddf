"""Compositions of operators: reports, the batch run, the training run."""

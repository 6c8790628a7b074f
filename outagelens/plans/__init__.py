"""Whole jobs: the batch run over incidents and the root-cause run."""

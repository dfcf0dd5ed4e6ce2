"""Whole jobs: exploration, training, scoring, retraining."""

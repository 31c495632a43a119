"""Scaling, isolation forest, classifiers, evaluation and the model registry."""

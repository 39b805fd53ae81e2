"""Marginalia: set-oriented analytics over citation corpora and text collections, on Spark."""

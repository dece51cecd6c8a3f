"""Applying fitted feature values to streams."""

"""Volumes assembled while tiles are still being acquired."""

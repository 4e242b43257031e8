"""Continuous jobs: change stream to bronze and silver, silver commits to gold."""

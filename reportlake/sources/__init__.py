"""Inputs: source specs, mixed-layout gzip CSV lakes, zip archives."""

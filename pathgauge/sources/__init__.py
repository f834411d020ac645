"""Readers and writers of input, stage and result tables."""

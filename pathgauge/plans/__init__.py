"""Stages of the workflow: tables in, one lazy table out."""

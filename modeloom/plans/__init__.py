"""Whole jobs and the materialisation points they share."""

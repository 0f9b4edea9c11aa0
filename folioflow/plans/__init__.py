"""Projection and filter language over nested records."""

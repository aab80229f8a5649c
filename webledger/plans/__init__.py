"""Registered queries: one per operator of the survey, each with its oracle."""

"""Layered plans: bronze to silver to gold, and the correlation report."""

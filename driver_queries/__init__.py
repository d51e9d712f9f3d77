"""Queries over the driver's tables, each with an independently written SQL counterpart."""

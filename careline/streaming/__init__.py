"""Micro-batch form of the daily increment."""

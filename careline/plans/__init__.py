"""Whole stages composed from the operators; each scans its reports once."""

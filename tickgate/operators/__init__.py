"""Operators: normalisation, quality checks, verdicts, planning, publishing."""

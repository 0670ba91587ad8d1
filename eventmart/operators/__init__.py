"""Operators: pure DataFrame -> DataFrame functions, no action and no session inside."""

"""Operators: DataFrame -> DataFrame functions planned by Catalyst."""

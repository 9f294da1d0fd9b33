"""Layered datasets built from the operators."""

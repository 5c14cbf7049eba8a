"""Whole models composed of the operators."""

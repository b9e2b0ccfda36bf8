"""Composed jobs and registered queries."""

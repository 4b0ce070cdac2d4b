"""Registered queries and the tables that they run over."""

"""Moves data between document collections and relational tables with Spark."""

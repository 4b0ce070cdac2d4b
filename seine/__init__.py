"""Hiring-data analytics and training-text preparation on Spark."""

"""Fact, dimension and trend models and the queries on top of them."""

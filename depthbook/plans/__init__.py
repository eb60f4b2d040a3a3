"""Registered queries, their SQL oracles and the views over the star schema."""

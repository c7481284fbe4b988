"""Models over models: aggregates, analyses, and the table graph that feeds them."""

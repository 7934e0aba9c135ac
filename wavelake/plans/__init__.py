"""Composite plans: questionnaire config, silver and gold products, SQL reports."""

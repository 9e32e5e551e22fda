"""Relational operators: cleaning, allocation, products, reports, schedules, classifier."""

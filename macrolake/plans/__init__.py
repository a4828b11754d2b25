"""Composed plans: the batch jobs of the lake and the registered check queries."""

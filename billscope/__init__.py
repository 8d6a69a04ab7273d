"""Subscription-billing analytics as Spark DataFrame operators."""

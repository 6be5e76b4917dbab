"""Data-quality checks and table preparation as Spark DataFrame operators."""

from tablecheck.rules import Rule, rules_from_json

__all__ = ["Rule", "rules_from_json"]

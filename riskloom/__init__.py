"""Fraud analytics on Spark: star-schema load, behavioural features, risk
scores, evaluation, a reporting star schema and the queries behind it."""

"""Factory telemetry and production analytics as Spark DataFrame operators."""

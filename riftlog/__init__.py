"""riftlog: log analytics and root-cause triage as Spark jobs."""

__version__ = "0.1.0"

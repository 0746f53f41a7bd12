"""Point-in-time daily-bar analytics as PySpark DataFrame transforms."""

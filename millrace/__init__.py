"""millrace: matching and text analytics as composable Spark DataFrame transforms."""

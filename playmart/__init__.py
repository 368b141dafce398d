"""Player-activity and bonus-risk analytics as composable Spark DataFrame operators."""

"""loadkit: DataFrame operators for declarative batch loads on Spark."""

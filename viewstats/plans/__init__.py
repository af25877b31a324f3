"""Layer jobs: each runs over a range of days as one set-oriented Spark job."""

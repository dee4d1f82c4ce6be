"""Sales lakehouse on Spark: landing files to typed tables, a star schema,
business views, purchase propensity and a weekly call queue."""

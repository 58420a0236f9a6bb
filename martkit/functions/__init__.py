"""Column and date helpers; every function here returns a built-in Spark expression or a plain date."""

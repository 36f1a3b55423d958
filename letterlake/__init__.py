"""letterlake: mail lifecycle analytics as Spark DataFrame transformations."""

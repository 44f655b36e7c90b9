"""Review analytics as Spark DataFrame jobs: cleaning, features, balancing, classifiers, topics."""

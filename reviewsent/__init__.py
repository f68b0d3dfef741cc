"""Review-text analytics on Spark: load, profile, clean, count words, train, evaluate, explore."""

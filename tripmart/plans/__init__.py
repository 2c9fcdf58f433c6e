"""Jobs: the public batch surface, each callable and runnable with spark-submit."""

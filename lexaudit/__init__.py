"""lexaudit: a Spark-first engine for auditing large collections of news pages, posts and trade records."""

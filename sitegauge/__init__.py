"""Site metrics on Spark: documents to series, growth, ranks and chart feeds."""

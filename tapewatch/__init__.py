"""Options-activity analytics on Spark: validate, flag, summarise, load, stream."""

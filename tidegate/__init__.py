"""Change-capture analytics on Spark: gate, typed layers, star schema, checks and gated publishing."""

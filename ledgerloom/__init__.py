"""Record linkage, rule classification and tiered analytics as Spark plans."""

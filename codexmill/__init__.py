"""codexmill: analytics over structured legal text, expressed as Spark plans."""

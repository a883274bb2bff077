"""folioforge: parsed documents in, clean records out, as Spark plans."""

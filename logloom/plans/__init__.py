"""From request bodies to DataFrame plans."""

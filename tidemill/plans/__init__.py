"""Ready flows composed from the operators: outlets, products, daily facts, calendar."""

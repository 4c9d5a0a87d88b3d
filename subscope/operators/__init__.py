"""DataFrame operators: cleaning, features, profiles, distributions and models."""

"""Column functions: the single definition of every rule, used by batch and streaming alike."""

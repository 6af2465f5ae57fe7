"""Jobs and named views built from the operators."""

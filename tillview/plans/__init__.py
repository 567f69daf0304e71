"""Jobs that chain the operators and write the layers."""

"""Jobs that chain the operators, and the registered queries with their SQL counterparts."""

"""Domain compositions of the operators: panel, indices, fact-checks, graph, forecast, views."""

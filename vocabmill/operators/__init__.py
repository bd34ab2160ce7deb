"""Graph, hierarchy, edition and quality operators."""

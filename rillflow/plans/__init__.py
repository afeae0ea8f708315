"""How work is spread: hot keys, ordered blocks, checked broadcasts, job plans."""
